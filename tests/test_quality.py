from pyspark.sql import functions as F

from ridemart.operators import quality


def test_column_tests_count_failures(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, None, 9), (None, "c", None), (2, "d", 9), (2, "e", 8)],
        "id int, name string, code int",
    )
    tests = [
        quality.not_null("name"),
        quality.not_null("id"),
        quality.unique("id"),
        quality.unique("name"),
        quality.accepted_values("code", [1, 2]),
    ]
    got = [(r["test_name"], r["column_name"], r["failures"], r["status"]) for r in quality.run_tests(rows, "t", tests).collect()]
    assert got == [
        ("not_null", "name", 1, "FAIL"),
        ("not_null", "id", 1, "FAIL"),
        ("unique", "id", 2, "FAIL"),  # two values occur more than once
        ("unique", "name", 0, "PASS"),
        ("accepted_values", "code", 2, "FAIL"),  # 8 and 9; null is not a value
    ]


def test_column_tests_on_an_empty_table_pass(spark):
    none = spark.createDataFrame([], "id int")
    got = quality.run_tests(none, "t", [quality.not_null("id"), quality.unique("id")]).collect()
    assert [(r["failures"], r["status"]) for r in got] == [(0, "PASS"), (0, "PASS")]


def test_score_of_no_checks_is_zero(spark):
    none = spark.createDataFrame([], "check_name string, records long, pct double, status string")
    row = quality.quality_score(none).first()
    assert (row["checks_run"], row["quality_score"]) == (0, 0.0)


def test_column_quality_needs_one_scan(inputs):
    plan = quality.column_quality(inputs.table("lineitem"))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("FileScan") == 1


def test_validity_needs_one_scan(inputs):
    report = quality.validity(inputs.raw, quality.validity_checks())
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_null_counts_add_up(inputs):
    long = quality.column_quality(inputs.raw, ["passenger_count", "RatecodeID"])
    assert long.filter(F.col("non_null") + F.col("null_count") != F.col("total_rows")).count() == 0
