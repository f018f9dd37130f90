import statistics
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridemart.operators.profile import numeric_summary
from ridemart.operators import quantiles
from ridemart.operators.quantiles import Bracket, approximate_quantiles, located, sketched, summarise

POINTS = {"p00": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def check(row, values):
    values = np.array(values, dtype=float)
    assert row["count"] == len(values)
    assert row["min"] == values.min() and row["max"] == values.max()
    # A sum of doubles is only as exact as its largest term.
    assert row["mean"] == pytest.approx(values.mean(), rel=1e-9, abs=1e-12 * abs(values).max())
    for name, p in POINTS.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), name
    if len(values) > 1:
        assert row["stddev"] == pytest.approx(values.std(ddof=1), rel=1e-6, abs=1e-6)
    else:
        assert row["stddev"] is None


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_mixed_signs_zero_and_tiny_values(spark):
    rng = random.Random(3)
    values = [rng.uniform(-50, 50) for _ in range(500)] + [0.0] * 40 + [1e-300, -1e-300, 1e12, -1e12]
    check(summarise(frame(spark, values), {"x": "x"}, POINTS).first(), values)


def test_one_value_holding_a_third_of_all_rows(spark):
    rng = random.Random(4)
    values = [7.25] * 1000 + [rng.lognormvariate(2, 1) for _ in range(2000)]
    check(summarise(frame(spark, values).repartition(7), {"x": "x"}, POINTS).first(), values)


def test_values_close_together(spark):
    """Dates as seconds: all in one bin, next to a far-away default that a third of the rows have."""
    rng = random.Random(5)
    values = [1.7e9 + rng.randrange(86_400 * 3) for _ in range(2000)] + [0.0] * 1000
    check(summarise(frame(spark, values), {"x": "x"}, POINTS).first(), values)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda v: round(v, 3)), min_size=1, max_size=60
    )
)
def test_any_values_match_brute_force(spark, values):
    check(summarise(frame(spark, values), {"x": "x"}, POINTS).first(), values)


def test_infinity_and_nan_sort_last(spark):
    values = [1.0, 2.0, math.inf, math.nan, -math.inf]
    row = summarise(frame(spark, values), {"x": "x"}, {"low": 0.0, "mid": 0.5, "last": 1.0}).first()
    assert row["mid"] == 2.0 and row["count"] == 5 and row["min"] == -math.inf


def test_many_metrics_keep_their_own_rows_and_order(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (-3.0, None)], "a double, b double")
    rows = summarise(
        df, {"b": "b", "a": F.when(F.col("a") > 0, F.col("a")), "none": F.lit(None)}, {"p50": 0.5}
    ).collect()
    assert [(r["metric"], r["count"], r["p50"]) for r in rows] == [("b", 1, 5.0), ("a", 2, 1.5), ("none", 0, None)]


def test_empty_input_gives_one_row_per_metric(spark):
    rows = numeric_summary(frame(spark, [1.0]).filter("false"), {"x": "x"}).collect()
    assert [(r["metric"], r["count"], r["median"]) for r in rows] == [("x", 0, None)]


def test_two_scans_and_only_values_inside_brackets_are_shuffled(spark, inputs):
    wide = inputs.table("lineitem").select(F.col("l_extendedprice").alias("p"))
    first = sketched(wide, [0.5], 0.01)
    low, high = (first.first()["m0"][side][0] for side in ("low", "high"))
    inside = wide.filter(F.col("p").between(low, high)).count()
    assert 0 < inside < 0.05 * wide.count()
    second = located(wide, {"p": [Bracket(low, high)]}, {"p": [wide.count() // 2]}, {"p": (0.0, 1e6)})
    second.collect()
    final = second._jdf.queryExecution().executedPlan().toString()
    final = final.split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_a_bracket_that_misses_widens(spark, monkeypatch):
    rng = random.Random(6)
    values = [rng.lognormvariate(2, 1) for _ in range(3000)] + [rng.uniform(-9, 9) for _ in range(500)]
    passes = []
    real = quantiles.located
    monkeypatch.setattr(quantiles, "located", lambda *a: passes.append(a[1]) or real(*a))
    for wrong in (Bracket(2.0, 2.0), Bracket(100.0, 101.0), Bracket(-math.inf, -math.inf)):
        passes.clear()
        monkeypatch.setattr(quantiles, "_first_brackets", lambda row, shares, errors: [wrong for _ in shares])
        check(summarise(frame(spark, values), {"x": "x"}, POINTS).first(), values)
        assert 1 < len(passes) < 8


def test_brackets_merge_and_open_ends():
    assert quantiles.merged([Bracket(3, 5), Bracket(1, 2), Bracket(4, 9), Bracket(None, 0)]) == [Bracket(None, 0), Bracket(1, 2), Bracket(3, 9)]
    assert quantiles.merged([Bracket(3, None), Bracket(4, 5)]) == [Bracket(3, None)]


def test_deviation_of_offset_columns(spark):
    near = [1e9 + i % 100 for i in range(20_000)]
    far = [1.7e15 + i for i in range(0, 1_000_000, 50)]
    for values in (near, far):
        row = summarise(frame(spark, values), {"x": "x"}, {"mid": 0.5}).first()
        assert row["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-9)
        assert row["mid"] == statistics.median(values)


def test_values_in_a_clump_are_cut_further(spark):
    rows = spark.range(50_000).selectExpr("1000000 + id / 50000 AS x").union(spark.createDataFrame([(1_003_000.0,)], "x double"))
    row = summarise(rows, {"x": "x"}, {"p25": 0.25, "mid": 0.5}).first()
    ordered = sorted(r["x"] for r in rows.collect())
    assert row["mid"] == ordered[25_000] and row["p25"] == pytest.approx(ordered[12_500], abs=1e-9)


def test_sketch_form_is_close(inputs):
    line = inputs.table("lineitem")
    row = approximate_quantiles(line, {"q": "l_quantity"}, [0.25, 0.5]).first()
    exact = summarise(line, {"q": "l_quantity"}, {"a": 0.25, "b": 0.5}).first()
    assert row["q"] == pytest.approx([exact["a"], exact["b"]], abs=1)
