import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ridemart.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest key reachable, by comparing all pairs; prints: list of (key, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    keys = {}
    for i, (k, _) in enumerate(prints):
        keys.setdefault(root(i), []).append(k)
    return [min((k for k in keys[root(i)] if k is not None), default=None) for i in range(len(prints))]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abÀé \t\n\v\f\r\x1c\x85\xa0Zz", max_size=60))
def test_fingerprint_matches_brute_force(text):
    assert simhash.fingerprint_of(text.encode()) == slow_fingerprint(text)


def test_fingerprint_of_long_and_empty_texts(monkeypatch):
    text = " ".join(f"W{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint_of(text.encode()) == slow_fingerprint(text)
    assert simhash.fingerprint_of(None) == simhash.fingerprint_of(b" \n") == 0


def test_distance_table_is_a_lower_bound(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63]
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = {r.fingerprint: r for r in simhash.pivot_table(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).collect()}
    for p, s in zip(prints, signed):
        assert list(table[s].row) == [(p ^ r).bit_count() for r in simhash.REFERENCES]
        pairs = [(p >> 2 * j & 3).bit_count() for j in range(32)]
        for g, group in enumerate(simhash.GROUPS):
            assert table[s].groups[g] == sum(pairs[j] * 3 ** (len(group) - 1 - k) for k, j in enumerate(group))
    for p, s in zip(prints, signed):
        for q, t in zip(prints, signed):
            assert max(abs(a - b) for a, b in zip(table[s].row, table[t].row)) <= (p ^ q).bit_count()


def near_copies(seed, n):
    """Fingerprints in balls around a few centres, and chains that leave them."""
    rng = random.Random(seed)
    out = []
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(n):
            flips = rng.sample(range(64), rng.choice([0, 1, 1, 2, 3, 6]))
            out.append(centre ^ sum(1 << b for b in flips))
        for _ in range(15):
            centre ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            out.append(centre)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("cell", [2, 8, 10**6])
def test_links_give_the_components_of_all_pairs(spark, cell):
    prints = near_copies(cell, 60)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = simhash.pivot_table(spark.createDataFrame([(p,) for p in signed], "fingerprint long"))
    edges = simhash.links(table, cell)
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in edges.collect())
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    want = slow_components([(s, p) for s, p in zip(signed, prints)])
    assert {s: found.get(s, s) for s in signed} == dict(zip(signed, want))


def test_components_of_stars_chains_and_repeats(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(300, 300), (7, 6), (7, 6)]
    found = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table_with_awkward_rows(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i, k in enumerate(rng.sample(range(300), 40))]
    rows += [(100 + i, " ".join(base)) for i in range(50)] + [(7, " ".join(base)), (7, " ".join(base))]
    rows += [(500, None), (499, ""), (None, " \n"), (None, "alone here"), (600, "one"), (601, "ONE"), (602, "x y " * 60_000)]
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, fingerprint int, component string, node int")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs.repartition(5), cell=3).collect()]
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    want = slow_components(prints)
    signed = [p - 2**64 if p >= 2**63 else p for _, p in prints]
    assert sorted(got, key=repr) == sorted(((i, s, c) for (i, _), s, c in zip(prints, signed, want)), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_registered_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, f"{p:016x}", c) for (i, p), c in zip(rows, slow_components(rows))}
    assert {tuple(r) for r in simhash.query(spark, data).collect()} == want
