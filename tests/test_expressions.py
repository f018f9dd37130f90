import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.labels import PAYMENT_TYPES, label, time_band
from ridemart.functions.numeric import half_even_int, percent, plain_text, rounded, safe_corr


def one(spark, column, **values):
    row = spark.range(1)
    for name, value in values.items():
        kind = "timestamp_ntz" if isinstance(value, dt.datetime) else None
        lit = F.lit(str(value)).cast(kind) if kind else F.lit(value)
        row = row.withColumn(name, lit)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value,expected", [(1.005, 1.0), (0.285, 0.28), (2.5, 2.5), (-1.005, -1.0)])
def test_rounding_keeps_the_binary_value(spark, value, expected):
    assert one(spark, rounded("v"), v=value) == expected


def test_rounding_matches_duckdb_on_random_values(spark):
    rng = random.Random(7)
    values = [rng.uniform(-500, 500) for _ in range(3000)] + [k / 1000 for k in range(-3000, 3000)]
    values += [k / 200 for k in range(2000)] + [10.0**k for k in range(-20, 300, 7)]
    values += [0.0049999999999999994, 0.005, 4503599627370497.5, 1e22, -1e22, float("inf"), -float("inf")]
    mine = [r["x"] for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded("v").alias("x")).collect()]
    con = duckdb.connect()
    theirs = [con.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    wrong = [(v, a, b) for v, a, b in zip(values, mine, theirs, strict=True) if str(a) != str(b)]
    assert not wrong


def test_rounding_null_and_zero_digits(spark):
    assert one(spark, rounded(F.lit(None).cast("double"))) is None
    assert one(spark, rounded("v", 0), v=2.5) == 3.0


def test_half_even_cast(spark):
    assert [one(spark, half_even_int("v"), v=v) for v in (0.5, 1.5, 2.5, 2.6)] == [0, 2, 2, 3]


def test_plain_text(spark):
    assert one(spark, plain_text("v"), v=12345678.9) == "12345678.9"
    assert one(spark, plain_text("v"), v=22.3) == "22.3"
    assert one(spark, plain_text("v"), v=22.0) == "22.0"


def test_percent_of_nothing_is_null(spark):
    assert one(spark, percent(F.lit(0), F.lit(0))) is None


def test_minute_boundaries_and_exact_minutes(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0)
    assert one(spark, t.minute_boundaries("a", "b"), a=a, b=b) == 1
    assert one(spark, t.elapsed_minutes("a", "b"), a=a, b=b) == 1 / 60
    c = dt.datetime(2024, 1, 2, 1, 0, 30)
    assert one(spark, t.minute_boundaries("a", "b"), a=a, b=c) == 1500
    assert one(spark, t.elapsed_minutes("a", "b"), a=c, b=a) == pytest.approx(-1499.5166666)


def test_weekday_numbering(spark):
    sunday = dt.datetime(2024, 1, 7, 12)
    assert one(spark, t.day_of_week("d"), d=sunday) == 0
    assert one(spark, t.weekday("d"), d=sunday) == 6
    assert one(spark, t.day_distance("a", "b"), a=dt.datetime(2024, 1, 1, 23, 59), b=dt.datetime(2024, 1, 2)) == 1


def test_calendar_fields_do_not_depend_on_the_session_zone(spark):
    gap = dt.datetime(2024, 3, 10, 2, 30)  # does not exist in New York
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, t.hour("d").cast("string"), d=gap) == "2"
        assert one(spark, t.day_start("d").cast("string"), d=gap) == "2024-03-10 00:00:00"
        later = dt.datetime(2024, 3, 10, 3, 30)
        assert one(spark, t.elapsed_minutes("a", "b"), a=gap, b=later) == 60
        assert one(spark, t.minute_boundaries("a", "b"), a=gap, b=later) == 60
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_time_bands(spark):
    hours = spark.range(24).select("id", time_band("id").alias("band")).collect()
    assert {r["id"] for r in hours if r["band"] == "morning_rush"} == {7, 8, 9}
    assert {r["id"] for r in hours if r["band"] == "evening_rush"} == {16, 17, 18, 19}


def test_labels_for_unknown_and_null_codes(spark):
    assert one(spark, label("c", PAYMENT_TYPES, "Other"), c=9) == "Other"
    assert one(spark, label(F.lit(None).cast("int"), PAYMENT_TYPES, "Other")) == "Other"
    assert one(spark, label("c", PAYMENT_TYPES), c=9) is None


def test_correlation_of_a_constant_is_null(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert rows.agg(safe_corr("x", "y").alias("c")).first()["c"] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (5.0, 10.0)], "x double, y double")
    assert line.agg(safe_corr("x", "y").alias("c")).first()["c"] == 1.0
