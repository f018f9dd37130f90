import math

import numpy as np
import pytest

from ridemart.llm import vector_search

SCHEMA = "vec_id long, embedding array<double>"


def slow(rows, k):
    """Sorted (query_id, rank, vec_id, score) by comparing every query with every row."""
    usable = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, q) in enumerate(usable):
        if i is None or i % 50:
            continue
        hits = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(usable) if a != b and len(v) == len(q)]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=repr)


def found(df, k, **sizes):
    out = vector_search.top_k(df, "vec_id % 50 = 0", k, **sizes)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    made = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(400)]
    made += [(1000 + i, [0.5] * 8) for i in range(150)]  # one vector that many share
    made += [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(2000, 2120)]  # many ties, other length
    made += [(None, [0.9] * 8), (50, made[50][1]), (50, made[50][1]), (100, [0.1] * 8), (-50, [0.2] * 3), (3000, [7.0])]
    made += [(3050, None), (3100, []), (3101, []), (3150, [1.0, None, 2.0]), (3200, [float("nan")] * 8), (3250, [float("inf")] * 8)]
    return made


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 30, "block_rows": 4}, {"shard_rows": 1, "block_rows": 1}])
def test_matches_brute_force(spark, rows, sizes, monkeypatch):
    monkeypatch.setattr(vector_search, "LEAF", 6)
    some = rows if sizes.get("shard_rows") != 1 else rows[:60]
    assert found(spark.createDataFrame(some, SCHEMA), 5, **sizes) == slow(some, 5)


def test_scores_beyond_exact_doubles(spark):
    big = 3.0e6 + 1 / 256
    rows = [(0, [big, 1.0]), (1, [big, 2.0]), (2, [big, 1.0]), (3, [big, 1 + 1 / 256]), (50, [-big, 0.5])]
    assert found(spark.createDataFrame(rows, SCHEMA), 6) == slow(rows, 6)
    huge = [(0, [1e300, -1e300]), (1, [1e300, 0.0]), (2, [-1e300, 0.0])]  # beyond a long: held at its bounds
    got = found(spark.createDataFrame(huge, SCHEMA), 6)
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_empty_and_clashing_names(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert vector_search.top_k(df.limit(0), "vec_id % 50 = 0").count() == 0
    assert vector_search.top_k(df.filter("vec_id = 1"), "vec_id % 50 = 0").count() == 0
    clashing = df.limit(60).selectExpr("*", "1 AS q", "2 AS data", "3 AS score", "4 AS rank", "5 AS query_id", "6 AS _asks")
    assert found(clashing, 3) == found(df.limit(60), 3)


def test_boxes_are_tight_and_leaves_bounded():
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(size=(500, 4)), np.zeros((300, 4))])
    tree = vector_search.build(np.arange(800), np.zeros(800, bool), points, leaf=16)
    assert sorted(tree["ids"].tolist()) == list(range(800))
    for node, (start, end) in enumerate(tree["spans"]):
        inside = tree["points"][start:end]
        assert (inside.min(0) == tree["low"][node]).all() and (inside.max(0) == tree["high"][node]).all()
        if not tree["children"][node]:
            assert end - start <= 16
        else:
            a, b = (tree["spans"][c] for c in sorted(tree["children"][node], key=lambda c: tree["spans"][c]))
            assert (start, end) == (a[0], b[1]) and a[1] == b[0] and abs((a[1] - a[0]) - (b[1] - b[0])) <= 1


def test_a_propagated_floor_prunes_leaves():
    points = np.sort(np.random.default_rng(2).normal(size=(4096, 2)), axis=0)
    tree = vector_search.build(np.arange(4096), np.zeros(4096, bool), points, leaf=16)
    visited = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            visited.append(key)
            return np.asarray(self)[key]

    watched = {**tree, "points": tree["points"].view(Watched)}
    query = np.array([[1.0, 1.0]])
    best = vector_search.search(watched, query, 3, [None])[0]
    first = len(visited)
    assert [s for s, _ in best] == [int(x) for x in np.sort(points @ query[0])[::-1][:3]]
    visited.clear()
    assert vector_search.search(watched, query, 3, [10**9])[0] == [] and len(visited) < first < 4096 // 16 // 2
