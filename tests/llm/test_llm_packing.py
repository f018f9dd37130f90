import collections
import itertools
import random

import pytest

from ridemart.llm import packing


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_the_best_of_all(seed):
    rng = random.Random(seed)
    histogram = {x: rng.choice([1, 1, 5, 100]) for x in rng.sample(range(1, 40), 8)}
    lengths = sorted(histogram)
    for buckets in (1, 2, 3, 5, 8, 20):
        bounds = packing.boundaries(histogram, buckets)
        choices = (
            [*cut, lengths[-1]] for k in range(min(buckets, 8)) for cut in itertools.combinations(lengths[:-1], k)
        )
        assert len(bounds) <= buckets and bounds == sorted(set(bounds)) and bounds[-1] == lengths[-1]
        assert padding(histogram, bounds) == min(padding(histogram, c) for c in choices)


def test_boundaries_of_nothing_one_length_and_no_bucket():
    assert packing.boundaries({}, 3) == [] and packing.boundaries({7: 3}, 4) == [7]
    with pytest.raises(ValueError):
        packing.boundaries({1: 1}, 0)


@pytest.fixture
def docs(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([1, 3, 10, 10, 10, 63, 64, 65, 128, 1000])) for i in range(700)]
    rows += [(None, 10), (None, None), (5000, 0), (5001, -3), (5002, 64 * 2000), (6, 10), (6, 10)]
    return spark.createDataFrame([(i, n, 9, "x") for i, n in rows], "doc_id long, n_tokens long, bucket int, slot string")


def checked(docs, buckets=4, budget=256, **more):
    packed = packing.pack(docs, max_tokens=64, buckets=buckets, batch_tokens=budget, **more).collect()
    pieces = collections.Counter()
    for d in docs.select("doc_id", "n_tokens").collect():
        n = max(d.n_tokens or 0, 0)
        for k in range(max(1, -(-n // 64))):
            pieces[(d.doc_id, k, 64 * k, min(64, n - 64 * k))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.n_tokens) for r in packed) == pieces
    histogram = collections.Counter(r.n_tokens for r in packed if r.n_tokens)
    bounds = packing.boundaries(histogram, buckets)
    batches = collections.defaultdict(list)
    for r in packed:
        if r.n_tokens == 0:
            assert (r.bucket, r.padded_to, r.batch, r.slot) == (None,) * 4
            continue
        assert r.padded_to == min(b for b in bounds if b >= r.n_tokens) == bounds[r.bucket]
        batches[(r.bucket, r.batch)].append(r.slot)
    for (bucket, batch), slots in batches.items():
        full = budget // bounds[bucket]
        last = max(b for k, b in batches if k == bucket)
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == full or batch == last and len(slots) < full)
    for bucket in {k for k, _ in batches}:
        assert sorted(b for k, b in batches if k == bucket) == list(range(1 + max(b for k, b in batches if k == bucket)))
    return packed


def test_batches_are_full_and_nothing_is_lost(docs):
    once = checked(docs)
    again = packing.pack(docs.repartition(5), max_tokens=64, buckets=4, batch_tokens=256).collect()
    assert collections.Counter(once) == collections.Counter(again)


def test_small_blocks_and_one_bucket(docs, monkeypatch):
    checked(docs, buckets=1)
    checked(docs, order=["slot"])


def test_empty_tables(docs):
    assert packing.pack(docs.limit(0)).count() == 0
    blank = packing.pack(docs.filter("coalesce(n_tokens, 0) <= 0")).collect()
    assert len(blank) == 3 and all(r.n_tokens == 0 and r.bucket is None for r in blank)
    with pytest.raises(ValueError):
        packing.pack(docs, max_tokens=10, batch_tokens=5)


def test_registered_query(spark):
    rows = packing.query(spark, "/root/testdata/sf0.001").collect()
    words = {r.doc_id: len(r.text.split()) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    total = collections.Counter()
    for r in rows:
        total[r.doc_id] += r.n_tokens
    assert total == words
