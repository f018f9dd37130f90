"""Importance resampling against plain counting."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from ridemart.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_features(text, order=1):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def slow_buckets(texts, buckets, order):
    return Counter(crc32(f.encode()) % buckets for t in texts for f in slow_features(t, order)[1])


def slow_rows(docs, target, buckets=10_000, order=1, share=10, least=20):
    s, t = slow_buckets([x for _, x in docs], buckets, order), slow_buckets(target, buckets, order)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        words, features = slow_features(text, order)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in features)
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(features), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * share // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(60)] + ["Éa", "éa", "x-y", "ÀB", "a b", "A1"]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12)))
    common = line()
    docs = [(k, "\n".join(rng.choice((common, line(), line())) for _ in range(rng.randrange(9)))) for k in range(200)]
    docs += [(None, "w1 " * 30), (300, None), (301, ""), (302, "\n\n"), (303, "..!"), (7, docs[7][1]), (304, "w2 " * 50_000)]
    return docs, [line() for _ in range(20)] + [None, ""]


@pytest.mark.parametrize(("order", "buckets"), [(1, 10_000), (2, 97), (3, 500)])
def test_counts_by_segment_equal_counts_of_whole_texts(spark, rows, order, buckets):
    docs = spark.createDataFrame([(t,) for _, t in rows[0]], "text string").repartition(4)
    got = {r.bucket: r.n for r in resampling.bucket_counts(docs, "text", buckets, order).collect()}
    assert got == dict(slow_buckets([t for _, t in rows[0]], buckets, order))


@pytest.mark.parametrize("order", [1, 2])
def test_whole_table_with_awkward_rows(spark, rows, order):
    docs = spark.createDataFrame([(i, t, 1.0, "s") for i, t in rows[0]], "doc_id long, text string, score double, rank string").repartition(5)
    target = spark.createDataFrame([(t, 1) for t in rows[1]], "text string, doc_id int")
    got = sorted((tuple(r) for r in resampling.resampled(docs, target, order=order).collect()), key=repr)
    assert got == slow_rows(*rows, order=order)
    assert resampling.resampled(docs.limit(0), target).count() == 0
    assert sorted((tuple(r) for r in resampling.resampled(docs, target.limit(0)).collect()), key=repr) == slow_rows(rows[0], [])


def test_ranks_of_tied_scores(spark):
    docs = [(k, "same words " * 20) for k in (5, 3, 9, None, 3)] + [(k, "same words") for k in range(10, 14)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = resampling.resampled(table, table.limit(0), share=60).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]


def test_hasher_forgets(monkeypatch):
    monkeypatch.setattr(resampling, "REMEMBERED", 3)
    hasher = resampling.Hasher(50)
    for _ in range(3):
        words = [f"v{k}".encode() for k in range(9)]
        assert np.array_equal(hasher.words(words), [crc32(w) % 50 for w in words])


def test_registered_query(spark):
    data = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert sorted((tuple(r) for r in resampling.query(spark, data).collect()), key=repr) == slow_rows(docs, target)
