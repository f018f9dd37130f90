import datetime as dt

import pandas as pd
import pytest

from ridemart.operators import marts, reports, verify
from ridemart.operators.breakdown import breakdown

DAY = dt.datetime(2024, 1, 1)


def series(spark, values, skip=()):
    """Daily mart with given trip counts; days in ``skip`` are left out."""
    rows = [
        (DAY + dt.timedelta(days=i), v, 10.0 + i, 2.0, 20.0, 100.0 * v, 15.0, v // 2, v // 3)
        for i, v in enumerate(values)
        if i not in skip
    ]
    return spark.createDataFrame(
        rows,
        "trip_date timestamp_ntz, total_trips long, avg_fare double, avg_distance double, "
        "avg_duration_min double, total_revenue double, avg_tip_pct double, morning_rush_trips long, "
        "evening_rush_trips long",
    )


@pytest.mark.parametrize("size", [2, 3, 4, 7, 8])
@pytest.mark.parametrize("length", [1, 2, 5, 7, 20])
def test_centred_mean_matches_pandas(spark, size, length):
    values = [(i * 37) % 11 + 1 for i in range(length)]
    daily = series(spark, values)
    got = [r["moving_avg"] for r in marts.centred_mean(daily, "total_trips", "trip_date", size).orderBy("trip_date").collect()]
    if length == 1:
        expected = [None]
    else:
        window = min(size, length)
        mean = pd.Series(values).rolling(window=window, center=True).mean()
        expected = [None if pd.isna(x) else x for x in mean]
    assert got == pytest.approx(expected)


def test_centred_mean_per_series(spark):
    rows = [(g, i, float(i * k)) for g, k in (("a", 1), ("b", 10)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = marts.centred_mean(df, "v", "i", 3, partition_by=["g"]).filter("i = 4").orderBy("g").collect()
    assert [r["moving_avg"] for r in got] == [4.0, 40.0]


def test_empty_marts(spark):
    none = series(spark, [])
    kpis = marts.daily_kpis(none).first()
    assert tuple(kpis) == (0, 0.0, 0.0, 0.0)
    assert verify.date_gaps(none).count() == 0
    assert verify.outlier_days(none).count() == 0
    assert verify.best_worst(none).count() == 0
    facts = {r["assertion"]: r["status"] for r in verify.assertions(none, none.selectExpr(
        "total_trips AS pickup_hour", "total_trips", "avg_fare", "avg_fare AS avg_speed_mph")).collect()}
    assert facts["daily: trip_date is unique"] == "PASS"
    assert facts["daily: total_trips > 0"] == "FAIL"


def test_date_gaps(spark):
    daily = series(spark, [5] * 10, skip={3, 6, 7})
    got = verify.date_gaps(daily).orderBy("gap_range").collect()
    assert [(r["gap_range"], r["missing_days"]) for r in got] == [
        ("2024-01-03 00:00:00 → 2024-01-05 00:00:00", 1),
        ("2024-01-06 00:00:00 → 2024-01-09 00:00:00", 2),
    ]


def test_best_and_worst_ties_go_to_the_earlier_day(spark):
    got = {r["metric"]: (r["date"][:10], r["value"]) for r in verify.best_worst(series(spark, [4, 9, 9, 2, 2])).collect()}
    assert got == {
        "Highest Trips": ("2024-01-02", "9"),
        "Lowest Trips": ("2024-01-04", "2"),
        "Highest Revenue": ("2024-01-02", "$900.0"),
        "Highest Avg Fare": ("2024-01-05", "$14.0"),
        "Lowest Avg Fare": ("2024-01-01", "$10.0"),
    }


def test_outliers_of_a_flat_series(spark):
    assert verify.outlier_days(series(spark, [5] * 8)).count() == 0
    odd = verify.outlier_days(series(spark, [5] * 12 + [50])).collect()
    assert len(odd) == 1 and odd[0]["total_trips"] == 50


def test_reconcile_reports_a_difference(spark, inputs):
    stg, daily = inputs.stg, inputs.daily
    assert verify.reconcile(stg, daily).first()["trips_match"] == "PASS"
    short = daily.filter("trip_date > timestamp_ntz'2024-01-01 00:00:00'")
    assert verify.reconcile(stg, short).first()["trips_match"] == "FAIL"


def test_normalising_without_a_positive_maximum(spark):
    df = spark.createDataFrame([(0.0, -1.0), (0.0, -4.0)], "a double, b double")
    zero = marts.max_normalise(df, ["a", "b"]).collect()
    assert [(r["a_norm"], r["b_norm"]) for r in zero] == [(0.0, 0.0), (0.0, 0.0)]
    same = marts.max_normalise(df, ["b"], otherwise="same").collect()
    assert sorted(r["b_norm"] for r in same) == [-4.0, -1.0]


def test_rush_ratio_without_morning_trips(spark):
    bands = spark.createDataFrame([("evening_rush", 10)], "time_of_day string, trips long")
    row = marts.rush_ratio_of_bands(bands).first()
    assert (row["evening_trips"], row["morning_trips"], row["rush_ratio"]) == (10, 0, None)


def test_calendar_and_filter(spark):
    calendar = marts.daily_calendar(series(spark, [1] * 40))
    assert calendar.first()["dow_name"] == "Monday"
    february = marts.filter_daily(calendar, ["February"], ["Weekend"]).collect()
    assert {r["dow_num"] for r in february} == {5, 6} and {r["month"] for r in february} == {"February"}
    assert marts.filter_daily(calendar, [], ["Weekday"]).count() == 0


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in (3, 3, 1, 1, 2, 2, 9)], "k int")
    got = breakdown(df, ["k"], {}, top=2).collect()
    assert [(r["k"], r["trip_count"]) for r in got] == [(1, 2), (2, 2)]


@pytest.mark.parametrize("bounded", [True, False])
def test_shares_are_of_all_rows_even_after_top_k(spark, bounded):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    got = breakdown(df.repartition(7), ["k"], {}, share="pct", top=2, bounded_keys=bounded).collect()
    assert got[0]["trip_count"] == 334 and got[0]["pct"] == 33.4 and got[1]["pct"] == 0.1


def test_totals_agree_at_every_level(inputs):
    clean = inputs.clean.count()
    daily = sum(r["total_trips"] for r in inputs.daily.collect())
    hourly = sum(r["total_trips"] for r in inputs.hourly.collect())
    assert clean == daily == hourly
    vendors = reports.vendor_distribution(inputs.raw).collect()
    assert sum(r["pct"] for r in vendors) == pytest.approx(100, abs=0.02)


def test_marts_do_not_depend_on_partitioning(inputs):
    """Counts exactly; doubles to one step of their rounding, as sums of doubles depend on order."""
    again = sorted(marts.daily_summary(inputs.stg.repartition(7)).collect())
    for left, right in zip(again, sorted(inputs.daily.collect()), strict=True):
        for a, b in zip(left, right):
            assert a == (pytest.approx(b, abs=0.0101) if isinstance(b, float) else b)


def test_route_flow_numbers_zones_in_order(spark):
    routes = spark.createDataFrame(
        [(50, 7, 10), (7, 50, 9), (7, 7, 8), (99, 7, 1)], "PULocationID long, DOLocationID long, trips long"
    )
    got = sorted((r["source"], r["target"], r["value"]) for r in marts.route_flow(routes, k=3).collect())
    assert got == [(0, 0, 8), (0, 1, 9), (1, 0, 10)]


def test_insights_name_the_busiest_day(make_trips):
    week = [
        {
            "tpep_pickup_datetime": dt.datetime(2024, 1, day, 17),
            "tpep_dropoff_datetime": dt.datetime(2024, 1, day, 17, 20),
            "payment_type": payment,
        }
        for day, payment in [(1, 1), (2, 1), (2, 2), (3, 1), (3, 3)]
    ]
    from ridemart.operators.cleaning import add_features

    row = reports.insights(add_features(make_trips(*week))).first()
    assert row["busiest_day"] == "Tuesday" and row["quietest_day"] == "Monday"  # tie goes to the earlier day
    assert row["card_share_pct"] == 75.0 and row["rush_ratio"] is None
