"""Layout along a space-filling curve: same rows, and filters on each column read a part of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridemart.sources import layout
from ridemart.sources.marts import write_parquet

GROUP = 16_384


def rows_scanned(spark, df):
    """Rows that the file scan hands on after pruning row groups and pages."""
    df = df.select("*")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def points(spark):
    """40,000 rows without order in two columns."""
    n = F.col("id")
    return spark.range(0, 40_000, 1, 4).select(
        n.alias("k"), F.pmod(F.xxhash64(n), F.lit(265)).cast("int").alias("zone"),
        (F.pmod(F.xxhash64(n, F.lit(1)), F.lit(1_000_000)) / 1e4).alias("minute"), F.lit(1).alias("part"),
    )


def test_interleaves_bits(spark):
    made = spark.range(1).select(layout.morton([F.lit(0b101), F.lit(0b011)], 3).alias("x")).first().x
    assert made == 0b100111
    with pytest.raises(ValueError):
        layout.morton([F.lit(1)] * 11, 6)


@pytest.mark.parametrize("count", [0, 1, 2, 7, 63])
def test_bucket_counts_borders_reached(spark, count):
    borders = [float(2 * k) for k in range(count)]
    values = [float(v) for v in range(-2, 2 * count + 3)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", layout.bucket(F.col("v"), borders).alias("b"))
    assert {r.v: r.b for r in rows.collect()} == {v: sum(v >= x for x in borders) for v in values}


def test_each_filter_reads_a_part(spark, points, tmp_path):
    plain = write_parquet(points, f"{tmp_path}/plain")
    curved = layout.write_along_curve(points, f"{tmp_path}/curved", ["zone", "minute"], files=4, row_group_bytes=GROUP)
    assert plain.exceptAll(curved).isEmpty() and curved.count() == points.count()
    for wanted in (F.col("zone") == 77, F.col("minute").between(20, 21)):
        assert curved.filter(wanted).exceptAll(plain.filter(wanted)).isEmpty()
        assert curved.filter(wanted).count() == plain.filter(wanted).count()
        full, part = (rows_scanned(spark, t.filter(wanted)) for t in (plain, curved))
        assert full == 40_000 and part <= 0.35 * full, (full, part)


def test_hot_cell_is_divided_among_files(spark, points):
    hot = points.withColumn("zone", F.when(F.col("k") % 3 > 0, 5).otherwise(F.col("zone"))).withColumn(
        "minute", F.when(F.col("zone") == 5, 1.0).otherwise(F.col("minute"))
    )
    ranged = layout.along_curve(hot, ["zone", "minute"], files=8)
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8


def test_partitions_and_replaced_ones(spark, points, tmp_path):
    path = f"{tmp_path}/t"
    both = points.withColumn("part", (F.col("k") % 2).cast("int"))
    layout.write_along_curve(both, path, ["zone"], partition_by=["part"])
    new = both.filter("part = 1 AND zone < 10")
    again = layout.write_along_curve(new, path, ["zone"], partition_by=["part"], only_these_partitions=True)
    assert again.filter("part = 0").count() == 20_000
    assert again.filter("part = 1").exceptAll(new).isEmpty() and again.columns == both.columns


def test_nulls_nan_times_and_empty_tables(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [(None, None), (float("nan"), at), (1.0, at + dt.timedelta(days=1)), (1.0, at), (-1.0, None)]
    df = spark.createDataFrame(rows, "`a.b` double, at timestamp_ntz")
    back = layout.write_along_curve(df, f"{tmp_path}/t", ["a.b", "at"])
    assert back.exceptAll(df).isEmpty() and back.count() == 5
    empty = layout.write_along_curve(df.limit(0), f"{tmp_path}/e", ["a.b", "at"])
    assert empty.count() == 0 and empty.columns == df.columns


def test_refuses_texts_and_taken_names(spark):
    df = spark.createDataFrame([("x", 1)], "s string, _curve int")
    with pytest.raises(ValueError):
        layout.splits(df, ["s"])
    with pytest.raises(ValueError):
        layout.along_curve(df, ["_curve"])
    with pytest.raises(ValueError):
        layout.along_curve(df, [])
