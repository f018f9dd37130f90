import collections
import zlib

import pytest

from ridemart.llm import sharding
from ridemart.llm.common import numbered


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_and_its_inverse(n):
    for seed in (1, 42):
        numbers = [sharding.permuted_number(i, n, seed) for i in range(n)]
        assert sorted(numbers) == list(range(n))
        for row in range(n):
            shard, slot = sharding.place_of(row, n, 7, seed)
            assert sharding.row_at(shard, slot, n, 7, seed) == row


def test_columns_agree_with_the_numbers(spark):
    for n in (1, 5, 333):
        rows = spark.range(n)
        got = {r.id: r.p for r in rows.withColumn("p", sharding.permuted(rows["id"], n, 42)).collect()}
        assert got == {i: sharding.permuted_number(i, n, 42) for i in range(n)}


def test_a_shuffled_order_has_no_long_runs(spark):
    n = 2000
    numbers = [sharding.permuted_number(i, n, 42) for i in range(n)]
    near = sum(abs(a - b) <= 1 for a, b in zip(numbers, numbers[1:]))
    assert near < 10


@pytest.fixture
def docs(spark):
    rows = [(i, f"text {i % 50} é") for i in range(300)] + [(None, None), (None, ""), (7, "text"), (7, "text"), (8, "x" * 300_000)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_law_of_rows(spark, docs):
    placed = sharding.shard(sharding.measured(docs), ["doc_id", "text_crc32", "size"], 40, block_rows=20).collect()
    assert sorted(r.row_number for r in placed) == list(range(305))
    by_shard = collections.defaultdict(list)
    for r in placed:
        assert (r.shard, r.slot) == sharding.place_of(r.row_number, 305, 40)
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert {len(s) for s in by_shard.values()} == {7, 8}
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs.collect())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == want


def test_places_do_not_depend_on_partitioning_or_block_size(docs):
    def places(df, block):
        rows = sharding.shard(sharding.measured(df), ["doc_id", "text_crc32", "size"], 11, block_rows=block).collect()
        return collections.Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows)

    assert places(docs, 20) == places(docs.repartition(9), 10_000)


def test_fewer_rows_than_shards_none_and_clashing_names(spark, docs):
    few = sharding.shard(docs.limit(3), ["doc_id"], 40).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert sharding.shard(docs.limit(0), ["doc_id"], 40).count() == 0
    clashing = docs.selectExpr("*", "1 AS shard", "'a' AS slot", "2 AS row_number")
    assert sharding.shard(clashing, ["doc_id", "text"], 4).columns == ["doc_id", "text", "row_number", "shard", "slot"]
    own = {c: 7 + i for i, c in enumerate(("_hash", "_block", "_first", "_N", "_p", "_in_group", "_rows", "rows", "__hash"))}
    kept = sharding.shard(docs.selectExpr("*", *[f"{v} AS {c}" for c, v in own.items()]), ["doc_id", "text"], 4)
    plain = sharding.shard(docs, ["doc_id", "text"], 4)
    assert kept.filter(" AND ".join(f"{c} = {v}" for c, v in own.items())).count() == docs.count()
    place = lambda df: collections.Counter((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert place(kept) == place(plain)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_numbers_within_groups(spark, block):
    rows = spark.range(500).selectExpr("id % 3 AS g", "id", "id % 2 AS tie").union(spark.range(40).selectExpr("9L", "1L", "1L"))
    got = collections.defaultdict(list)
    for r in numbered(rows, ["g"], ["id"], "no", block_rows=block).collect():
        got[r.g].append(r.no)
    assert {g: sorted(v) == list(range(len(v))) for g, v in got.items()} == {0: True, 1: True, 2: True, 9: True}


def test_no_python_in_the_plan(spark):
    plan = sharding.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
