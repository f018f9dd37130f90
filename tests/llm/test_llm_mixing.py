import collections
import math
import re

import pytest

from ridemart.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_filled(sizes, weights=(1.0, 2.0, 3.0), cap=3):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return {s: share.get(s, cap * sizes[s]) for s in names}
        capped |= over


def text(n, tag=""):
    return " ".join(f"w{tag}{i}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for s, (source, many) in enumerate([("a", 900), ("b", 40), ("B", 30), ("é", 25), (None, 30), ("", 20), ("z", 3)]):
        rows += [(1000 * s + i, text(1 + (i * 37 + s) % 90, s), source) for i in range(many)]
    rows += [(9000 + i, text(20), "a") for i in range(300)]  # a hot cell of equal sizes
    rows += [(None, None, "a"), (None, "", None), (5, " \t\n\v\f\r ", "b"), (1, text(38), "a"), (1, text(38), "a"), (8888, text(5000), "é")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7).cache()


@pytest.fixture(scope="module")
def mixed(docs):
    return mixing.mix(docs).collect()


def totals(docs):
    out = collections.Counter()
    for r in docs.collect():
        out[r.source] += len(WORD.findall(r.text or ""))
    return out


def test_targets_are_water_filled(docs, mixed):
    want = water_filled(totals(docs))
    source = {(r.doc_id, len(WORD.findall(r.text or ""))): r.source for r in docs.collect()}
    got = {source[(r.doc_id, r.size)]: r.target for r in mixed if r.doc_id is not None}
    assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_taken_words_meet_the_targets(docs, mixed):
    assert len(mixed) == docs.count() and all(0 <= r.copies <= 3 for r in mixed)
    taken, target = collections.Counter(), {}
    for r in mixed:
        taken[r.target] += r.copies * r.size
        target[r.target] = r.source_size
    largest = 5000
    for t, size in target.items():
        assert abs(taken[t] - t) <= max(0.02 * t, 0.02 * largest), (t, size, taken[t])


def test_rates_are_exponential_tilts(spark):
    docs = spark.createDataFrame([(i, text(1 + i % 60), "a" if i % 5 else "b") for i in range(4000)], "doc_id long, text string, source string")
    by_size = collections.defaultdict(list)
    for r in mixing.mix(docs, weights=(1.0, 1.0)).collect():
        by_size[(r.source_size, r.size)].append((r.copies, r.target))
    for source_size in {k[0] for k in by_size}:
        cells = {k[1]: v for k, v in by_size.items() if k[0] == source_size}
        rows = [(size, len(v), v[0][1]) for size, v in cells.items()]
        target, mean = rows[0][2], source_size / sum(n for _, n, _ in rows)
        low, high = -50.0, 50.0
        for _ in range(200):
            middle = (low + high) / 2
            words = sum(n * size * min(3, math.exp(middle * size / mean)) for size, n, _ in rows)
            low, high = (middle, high) if words < target else (low, middle)
        for size, v in cells.items():
            rate = min(3, math.exp(low * size / mean))
            got = sum(c for c, _ in v)
            assert abs(got - rate * len(v)) <= 1.0001, (size, got, rate * len(v))
            assert max(c for c, _ in v) - min(c for c, _ in v) <= 1


def test_reruns_agree(docs, mixed):
    again = mixing.mix(docs.repartition(3)).collect()
    assert collections.Counter(mixed) == collections.Counter(again)


def test_nothing_and_one_source_and_no_words(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    one = mixing.mix(docs.filter("source = 'a'")).collect()
    assert {r.target for r in one} == {float(one[0].source_size)} and all(r.copies == 1 for r in one if r.size)
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mixing.mix(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_clashing_names(docs):
    clashing = docs.selectExpr("*", "1 AS size", "2 AS target", "3 AS copies", "4 AS key", "'x' AS source_key", "9 AS rows")
    assert mixing.mix(clashing).columns == ["doc_id", "size", "source_size", "target", "copies"]
