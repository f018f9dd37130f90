"""Repeated byte strings against a count of all strings of the length."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import suffix_dedup
from ridemart.llm.suffix_dedup import Cuts


def slow_rows(rows, length):
    """(id, bytes, spans, kept) by counting every string."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        gone = [False] * len(b)
        end = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                for k in range(max(i, end), i + length):
                    gone[k] = True
                end = i + length
        spans = [i for i in range(len(b) + 1) if (i < len(b) and gone[i]) != (i > 0 and gone[i - 1])]
        out.append((doc_id, len(b), list(zip(spans[::2], spans[1::2])), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def found_rows(docs, length):
    found = suffix_dedup.without_repeats(docs, length=length).collect()
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found), key=repr)


@pytest.mark.parametrize("length", [20, 60, 400])
def test_a_string_and_its_copies_are_cut_alike(length):
    rng, cuts = random.Random(length), Cuts(length)
    for letters in ("ab", "abcdefghij", "a"):
        for _ in range(60):
            string = "".join(rng.choice(letters) for _ in range(length))
            ends = []
            for _ in range(2):
                before = "".join(rng.choice(letters) for _ in range(rng.randrange(3 * length)))
                text = (before + string + "".join(rng.choice(letters) for _ in range(rng.randrange(length)))).encode()
                at = cuts.of(text)
                assert np.array_equal(at, np.unique(at))
                inside = at[(at >= len(before) + cuts.lead) & (at <= len(before) + length - cuts.tail)] - len(before)
                ends.append(inside.tolist())
            assert ends[0] == ends[1] and len(ends[0]) >= 2 and ends[0][0] < cuts.lead + cuts.window


def test_ranks_are_those_of_sorted_suffixes(spark):
    rng = random.Random(4)
    strings = [[rng.randrange(k) for _ in range(rng.randrange(1, 40))] for k in (1, 2, 2, 3, 5) for _ in range(6)]
    rows = [(t, i, s, 1, True) for t, string in enumerate(strings) for i, s in enumerate(string) if (t, i) != (5, 7)]
    symbols = spark.createDataFrame(rows, "text long, place long, symbol long, size long, more boolean").repartition(4)
    got = {(r.text, r.place): r["rank"] for r in suffix_dedup.suffix_ranks(symbols, 1000).collect()}
    assert len(got) == len(rows)

    def suffix(t, i):
        out = []
        while i < len(strings[t]) and (t, i) != (5, 7):
            out.append(strings[t][i])
            i += 1
        return out

    order = sorted(got, key=lambda p: got[p])
    suffixes = [suffix(*p) for p in order]
    assert suffixes == sorted(suffixes)


@pytest.mark.parametrize(("seed", "length"), [(1, 20), (2, 40), (3, 60)])
def test_edited_copies_and_junk(spark, seed, length):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop"[:k]) for _ in range(rng.randrange(1, 8)))
    rows = []
    for k in (2, 4, 16):
        base = " ".join(word(k) for _ in range(60))
        for _ in range(12):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice("xyzé")
            a = rng.randrange(len(text))
            text[a:a] = rng.choice(("", "junk", word(k), "ha" * 40))
            rows.append("".join(text))
        for _ in range(8):  # passages of about the length inside other text
            a = rng.randrange(len(base) - length)
            rows.append(" ".join(word(16) for _ in range(9)) + base[a : a + length + rng.randrange(-3, 6)] + " ".join(word(16) for _ in range(9)))
    rows += ["z" * (length + 5), "z" * 3, "z" * (length - 1), "q" * length, "é" * length, "ha" * 3 * length, "xyz" * length]
    rows += [" ".join(word(16) for _ in range(80)) for _ in range(6)]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_rows(docs, length) == slow_rows(rows, length)


def test_cuts_of_a_very_common_core_are_dealt_out(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(120))
    junk = [" ".join(word() for _ in range(40)) + "ha " * rng.randrange(500, 900) for _ in range(20)]
    held = [" ".join([*(word() for _ in range(40)), passage, *(word() for _ in range(40))]) for _ in range(200)]
    rows = [(i, t.encode()) for i, t in enumerate([*junk, *held, *(" ".join(word() for _ in range(150)) for _ in range(50))])]
    cuts, cores = Cuts(), Counter()
    for i, data in rows:
        for k, a in enumerate(cuts.of(data).tolist()):
            if a >= cuts.lead and a + cuts.compared <= len(data):
                cores[data[a - cuts.lead : a - cuts.lead + cuts.core]] += 1
    texts = spark.createDataFrame(rows, "text long, data binary").repartition(5)
    assert max(cores.values()) >= 200
    assert suffix_dedup._shared(texts, cuts).count() == sum(n for n in cores.values() if n > 1)
    largest = suffix_dedup._cores(texts, cuts).groupBy("core").count().agg({"count": "max"}).first()[0]
    assert largest <= 5  # one of each task


@pytest.fixture
def ranges_apart(spark):
    """Ranges of few rows are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_where_a_symbol_fills_ranges(spark, ranges_apart, monkeypatch):
    strings, purposes, counted = [[3] * (20 + t % 7) + [t % 2] for t in range(60)], [], suffix_dedup._counted
    monkeypatch.setattr(suffix_dedup, "_counted", lambda *a: purposes.append(a[-1]) or counted(*a))
    rows = [(t, i, s, 1, True) for t, string in enumerate(strings) for i, s in enumerate(string)]
    symbols = spark.createDataFrame(rows, "text long, place long, symbol long, size long, more boolean")
    ranks = [((r.text, r.place), r["rank"]) for r in suffix_dedup.suffix_ranks(symbols, 1000).collect()]
    suffixes = {(t, i): tuple(strings[t][i:]) for t, i, *_ in rows}
    ordered = sorted(suffixes.values())
    assert dict(ranks) == {k: ordered.index(v) for k, v in suffixes.items()}
    assert "suffix_inner" in purposes


def test_equal_keys_fill_many_ranges(spark, ranges_apart):
    rng = random.Random(5)
    keys = [(7, 7)] * 3000 + [(rng.randrange(12), rng.randrange(12)) for _ in range(600)] + [(99, 0)]
    rows = [(i % 40, i // 40, x, y, rng.random() < 0.3) for i, (x, y) in enumerate(keys)]
    table = spark.createDataFrame(rows, "text long, place long, x long, y long, mark boolean").repartition(6)
    counted = suffix_dedup._counted(table, ["x", "y"], F.col("mark"), ["text", "place"], "test_counted")
    before = {k: (sum(o < k for o in keys), sum(r[4] for r in rows if r[2:4] < k), keys.count(k) > 1) for k in set(keys)}
    got = {(r.text, r.place): (r.before, r.marks_before, r.tied) for r in counted.collect()}
    assert got == {r[:2]: before[r[2:4]] for r in rows}
    ranges = spark.read.parquet(*set(counted.inputFiles())).groupBy("part").count()
    assert ranges.agg(F.max("count")).first()[0] < len(rows) / 2


def test_contexts_of_equal_rank_and_core_are_dealt_out(spark):
    rows = [(a, 0, a, 0, 9, 5, 1, [1, 2]) for a in range(4000)]
    contexts = spark.createDataFrame(rows, "around long, rank long, text long, first long, last long, core long, own int, prefixes array<int>")
    met = suffix_dedup._meeting(contexts).collect()
    assert sorted(r.around for r in met) == list(range(4000)) and all(r.sure for r in met if r.core != 5)
    assert sum(r.core == 5 for r in met) < 400


def test_whole_table_with_awkward_rows(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    one, two = text(300), text(90)
    rows = [(1, one), (2, one), (2, one), (None, two), (None, None), (3, ""), (4, text(50) + two + text(60)), (5, text(200)), (6, "é" * 300), (7, text(20_000) + one)]
    docs = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in rows], "doc_id long, text string, at int, spans string, rank int").repartition(3)
    assert found_rows(docs, 400) == slow_rows(rows, 400)
    assert found_rows(docs.limit(0), 400) == []


def test_registered_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = {(i, n, sum(b - a for a, b in spans), len(spans), sha256(kept).hexdigest()) for i, n, spans, kept in slow_rows(rows, 400)}
    assert {tuple(r) for r in suffix_dedup.query(spark, data).collect()} == want
    assert any(w[2] for w in want)
