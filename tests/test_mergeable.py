"""Comparison by checksums, co-moments, distinct sketches, heavy groups and kept-up samples."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from ridemart.operators import comoments, differences, distinct, heavy
from ridemart.operators.sampling import sample_rows
from ridemart.plans import build
from ridemart.sources.marts import write_parquet

ROWS = "k long, v string, x double"


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS).repartition(3)


def brute(left, right):
    """Differing keys by counting whole rows in Python."""
    a, b = collections.Counter(left), collections.Counter(right)
    out = {}
    for k in {r[0] for r in (*a, *b)}:
        rows = [r for r in {*a, *b} if r[0] == k]
        more, less = sum(max(a[r] - b[r], 0) for r in rows), sum(max(b[r] - a[r], 0) for r in rows)
        if more + less:
            matched = any(a[r] and b[r] for r in rows)
            one_side = not (more and less)
            out[k] = (more, less, "repeated" if matched and one_side else "changed" if more and less else "only left" if more else "only right")
    return out


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differing_keys_are_those_of_brute_force(spark, buckets):
    rng = random.Random(3)
    left = [(rng.choice([None, *range(60)]), rng.choice(["a", "", None]), rng.choice([1.5, None, 0.0])) for _ in range(300)]
    right = [r for r in left if rng.random() > 0.1] + [(99, "new", 1.0), (5, "a", 1.5)]
    got = differences.differing_keys(table(spark, left), table(spark, right), ["k"], buckets).collect()
    assert {r.k: (r.left_rows, r.right_rows, r.change) for r in got} == brute(left, right)


def test_nulls_in_other_columns_tell_rows_apart(spark):
    a = spark.createDataFrame([(1, "z", None)], "k long, a string, b string")
    b = spark.createDataFrame([(1, None, "z")], "k long, a string, b string")
    assert [r.change for r in differences.differing_keys(a, b, ["k"]).collect()] == ["changed"]


def test_equal_tables_have_no_differing_bucket_and_empty_ones_compare(spark):
    rows = table(spark, [(i % 50, str(i), 1.0) for i in range(500)])
    sums = lambda df: differences.checksums(df, ["k"], 16)
    assert differences.differing_buckets(sums(rows), sums(rows.repartition(9))).count() == 0
    assert differences.differing_keys(rows, rows, ["k"]).count() == 0
    assert differences.differing_keys(rows.limit(0), rows.limit(0), ["k"]).count() == 0
    assert {r.change for r in differences.differing_keys(rows.limit(0), rows, ["k"]).collect()} == {"only right"}


def test_checksums_of_parts_add_up(spark):
    rows = table(spark, [(i % 50, str(i), 1.0) for i in range(500)])
    parts = [differences.checksums(rows.filter(F.col("k") % 3 == i), ["k"], 16) for i in range(3)]
    added = parts[0].union(parts[1]).union(parts[2]).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")])
    assert differences.differing_buckets(added, differences.checksums(rows, ["k"], 16)).count() == 0


def test_tables_of_other_columns_are_refused(spark):
    with pytest.raises(ValueError):
        differences.differing_keys(spark.range(3), spark.range(3).selectExpr("id AS k"), ["id"])


def test_only_rows_of_differing_buckets_are_compared(spark, tmp_path):
    for side, changed in (("a", -1), ("b", 4321)):
        spark.range(20_000).selectExpr("id AS k", f"if(id = {changed}, 1, 0) AS v").write.parquet(f"{tmp_path}/{side}")
    left, right = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    found = differences.differing_keys(left, right, ["k"])
    assert [(r.k, r.change) for r in found.collect()] == [(4321, "changed")]
    named = differences.differing_buckets(differences.checksums(left, ["k"]), differences.checksums(right, ["k"]))
    assert named.count() == 1
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("offset", "less"), [(0.0, 0.0), (1e5, 0.0), (1e9, 1e9)])
def test_merged_co_moments_equal_corr_on_offset_columns(spark, offset, less):
    rows = spark.range(4000).select(
        (F.col("id") % 12).alias("month"),
        F.rand(1).alias("u"),
        F.when(F.col("id") % 7 != 0, F.rand(1) * 0.3 + F.rand(2) + F.col("id") % 12).alias("w"),
    )
    rows = rows.withColumns({"x": F.col("u") + offset, "y": F.col("w") - offset})
    rows = rows.cache()
    pairs = {"xy": (F.col("x") - less, F.col("y") + less), "xx": (F.col("x") - less, F.col("x") - less)}
    states = comoments.co_moments(rows, ["month"], pairs)
    got = comoments.correlation_row(states, list(pairs), digits=None).first()
    whole = rows.filter("y IS NOT NULL").agg(F.corr(F.col("x") - less, F.col("y") + less)).first()[0]
    assert got.xy == pytest.approx(whole, abs=1e-9) and got.xx == pytest.approx(1, abs=1e-9)
    halves = comoments.merged(states.withColumn("half", F.col("month") % 2), ["half"])
    again = comoments.correlation_row(halves.drop("half"), list(pairs), digits=None).first()
    assert again.xy == pytest.approx(whole, abs=1e-9)
    assert states.filter("pair = 'xy'").agg(F.sum("n")).first()[0] == rows.filter("y IS NOT NULL").count()
    rows.unpersist()


def test_constant_missing_and_empty_pairs_have_no_correlation(spark):
    rows = spark.createDataFrame([(1, 2.0, None), (1, 2.0, 3.0), (2, 2.0, 4.0)], "g long, x double, y double")
    for df in (rows, rows.limit(0), rows.filter("y IS NULL")):
        states = comoments.co_moments(df, ["g"], {"xy": ("x", "y")})
        assert comoments.correlation_row(states, ["xy"]).first().xy is None


def test_merged_sketches_are_within_their_bound(spark):
    rows = spark.range(60_000).selectExpr("id % 30 AS day", "id % 20011 AS v", "if(id % 2 = 0, id % 5, null) AS few")
    states = distinct.distinct_states(rows, ["day"], {"v": "v", "few": "few"})
    assert {r.n_few for r in states.collect()} <= {0, 5, 1, 2, 3, 4} and states.count() == 30
    about = distinct.estimated(distinct.merged(states)).first()
    assert about.rows == 60_000 and about.about_few == 5
    assert abs(about.about_v / 20011 - 1) <= distinct.error_bound() < 0.07
    assert rows.select(distinct.within_bound(F.lit(about.about_v), F.lit(20011))).first()[0]
    assert not rows.select(distinct.within_bound(F.lit(22000), F.lit(20011))).first()[0]


def test_a_month_of_days_is_near_each_exact_day(spark):
    rows = spark.range(9000).selectExpr("id % 3 AS day", "id AS v")
    for r in distinct.estimated(distinct.distinct_states(rows, ["day"], {"v": "v"}, log_size=10)).collect():
        assert r.n_v == 3000 and abs(r.about_v / r.n_v - 1) <= distinct.error_bound(10)


def top(rows, k):
    ordered = sorted(collections.Counter(rows).items(), key=lambda x: (-x[1], [(v is None, v) for v in x[0]]))
    return [(*key, n) for key, n in ordered[:k]]


@pytest.mark.parametrize(("k", "tracked", "buckets"), [(5, 8192, 65_536), (5, 8, 16), (1, 16, 1), (400, 512, 64)])
def test_top_groups_are_exact(spark, k, tracked, buckets):
    rng = random.Random(k)
    rows = [(rng.choice([None, *range(4)]), int(rng.paretovariate(0.6)) % 900) for _ in range(4000)]
    got = heavy.top_groups(spark.createDataFrame(rows, "a long, b long").repartition(5), ["a", "b"], k, "n", tracked, buckets)
    assert [tuple(r) for r in got.collect()] == top(rows, k)


def test_ties_and_all_equal_groups_fall_through_to_the_full_grouping(spark):
    rows = spark.range(3000).selectExpr("id % 1500 AS a")
    got = heavy.top_groups(rows, ["a"], 10, "n", tracked=64)
    assert [tuple(r) for r in got.collect()] == [(i, 2) for i in range(10)]
    hashes = heavy.candidate_hashes(rows, ["a"], 10, 64)
    counts = heavy.counted(rows, ["a"], hashes, 8)
    assert counts.filter("NOT _is").count() == heavy.suspects(counts, 10).count() == 8


def test_standing_out_groups_need_no_third_scan(spark):
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, id % 10, id) AS a")
    hashes = heavy.candidate_hashes(rows, ["a"], 5)
    counts = heavy.counted(rows, ["a"], hashes)
    assert heavy.suspects(counts, 5).isEmpty() and counts.agg(F.sum("rows")).first()[0] == 20_000


def test_fewer_groups_than_wanted_and_none(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,)], "a long")
    assert [tuple(r) for r in heavy.top_groups(rows, ["a"], 9, "n").collect()] == [(1, 2), (None, 1)]
    assert heavy.top_groups(rows.limit(0), ["a"], 9).count() == 0
    with pytest.raises(ValueError):
        heavy.top_groups(rows, ["a"], 0)


def test_kept_up_samples_follow_changed_and_emptied_months(spark, tmp_path):
    def months(rows, held):
        path = f"{tmp_path}/trips{len(list(tmp_path.iterdir()))}"
        return write_parquet(rows, path, partition_by=[build.YEAR, build.MONTH]), held

    rows = spark.range(3000).selectExpr("id", "2024 AS pickup_year", "CAST(1 + id % 3 AS INT) AS pickup_month")
    every = {(2024, m) for m in (1, 2, 3)}
    ids = lambda df: sorted(r.id for r in df.collect())
    first, held = months(rows, every)
    drawn = build.update_samples(first, held, f"{tmp_path}/kept", 50, ["id"], held)
    assert drawn.count() == 150 and ids(sample_rows(drawn, 50, ["id"])) == ids(sample_rows(rows, 50, ["id"]))
    changed = rows.filter("pickup_month <> 2").withColumn("id", F.when(F.col("pickup_month") == 3, F.col("id") + 10_000).otherwise(F.col("id")))
    second, held = months(changed, every - {(2024, 2)})
    drawn = build.update_samples(second, held, f"{tmp_path}/kept", 50, ["id"], {(2024, 2), (2024, 3)})
    assert ids(sample_rows(drawn, 50, ["id"])) == ids(sample_rows(changed, 50, ["id"])) and drawn.count() == 100
