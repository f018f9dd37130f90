import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridemart.operators import cleaning, quality
from ridemart.operators.columns import Window
from ridemart.plans.catalog import WINDOW

PICKUP = dt.datetime(2024, 1, 8, 8, 0, 30)


def after(minutes, seconds=0):
    return PICKUP + dt.timedelta(minutes=minutes, seconds=seconds)


RULES = cleaning.cleaning_rules(WINDOW)


@pytest.mark.parametrize(
    "change,kept",
    [
        ({}, True),
        ({"fare_amount": 500.0}, False),
        ({"fare_amount": 499.99}, True),
        ({"fare_amount": 0.0}, False),
        ({"trip_distance": 200.0}, False),
        ({"trip_distance": 0.0}, False),
        ({"passenger_count": None}, False),
        ({"passenger_count": 0.0}, False),
        ({"passenger_count": 6.0}, True),
        ({"passenger_count": 7.0}, False),
        ({"total_amount": 0.0}, False),
        ({"tpep_dropoff_datetime": PICKUP}, False),
        ({"tpep_dropoff_datetime": after(180, 29)}, True),
        ({"tpep_dropoff_datetime": after(180, 30)}, False),  # crosses a 181st minute mark
        ({"tpep_pickup_datetime": dt.datetime(2024, 4, 1), "tpep_dropoff_datetime": dt.datetime(2024, 4, 1, 1)}, False),
        ({"tpep_pickup_datetime": dt.datetime(2024, 1, 1), "tpep_dropoff_datetime": dt.datetime(2024, 1, 1, 1)}, True),
    ],
)
def test_each_bound(make_trips, change, kept):
    trips = make_trips(change)
    assert cleaning.clean(trips, RULES).count() == int(kept)
    assert cleaning.rejects(trips, RULES).count() == int(not kept)


def test_features(make_trips):
    row = cleaning.add_features(make_trips({})).first()
    assert (row["pickup_hour"], row["pickup_dow"], row["pickup_month"]) == (8, 1, 1)
    assert row["trip_duration_min"] == 15
    assert row["avg_speed_mph"] == 12.0
    assert row["tip_pct"] == 25.0
    assert row["time_of_day"] == "morning_rush"


def test_trip_within_one_minute_has_no_speed(make_trips):
    row = cleaning.add_features(make_trips({"tpep_dropoff_datetime": after(0, 20)})).first()
    assert row["trip_duration_min"] == 0 and row["avg_speed_mph"] is None


def test_tip_percent_without_a_fare(make_trips):
    rows = cleaning.add_features(make_trips({"fare_amount": 0.0}, {"fare_amount": -5.0})).collect()
    assert [r["tip_pct"] for r in rows] == [0.0, 0.0]


def test_reject_reason_is_the_first_broken_rule_and_names_nulls(make_trips):
    trips = make_trips(
        {"fare_amount": -1.0, "passenger_count": None}, {"passenger_count": None}, {"passenger_count": 9.0}
    )
    got = [(r["reason"], r["outcome"]) for r in cleaning.rejects(trips, RULES).collect()]
    assert sorted(got) == [
        ("fare_amount > 0", "failed"),
        ("passenger_count <= 6", "failed"),
        ("passenger_count >= 1", "null"),
    ]


def test_nothing_is_lost_between_kept_and_rejected(inputs):
    raw = inputs.raw
    summary = cleaning.clean_summary(raw, RULES).first()
    reasons = cleaning.reject_reasons(raw, RULES).agg(F.sum("records").alias("n")).first()["n"]
    assert summary["rows_before"] == raw.count()
    assert summary["rows_after"] == inputs.clean.count()
    assert summary["rows_removed"] == reasons


def test_empty_input(make_trips):
    none = make_trips({}).filter("false")
    summary = cleaning.clean_summary(none, RULES).first()
    assert (summary["rows_before"], summary["rows_after"], summary["pct_removed"]) == (0, 0, None)
    checks = quality.validity(none, quality.validity_checks())
    assert checks.count() == 10 and checks.filter("status = 'FAIL'").count() == 0


def test_checks_and_cleaning_keep_their_own_bounds(make_trips):
    edge = make_trips({"fare_amount": 500.0}, {"trip_distance": 200.0})
    flagged = {r["check_name"]: r["records"] for r in quality.validity(edge, quality.validity_checks()).collect()}
    assert flagged["Fare exceeds $500"] == 0 and flagged["Distance exceeds 200 miles"] == 0
    assert cleaning.clean(edge, RULES).count() == 0


def test_staging_types(make_trips):
    staged = cleaning.stage(cleaning.clean(make_trips({"passenger_count": 2.5}), RULES))
    assert staged.first()["passenger_count"] == 2
    kinds = dict(staged.dtypes)
    assert kinds["passenger_count"] == "int" and kinds["pickup_hour"] == "bigint"
    assert kinds["pickup_at"] == "timestamp_ntz" and len(kinds) == 20


def test_date_range_includes_its_end(make_trips):
    window = Window("2024-01-01 00:00:00", "2024-01-08 08:00:30", 1)
    row = quality.date_consistency(make_trips({}), window).first()
    assert (row["range_check"], row["month_coverage"]) == ("PASS", "PASS")
    late = quality.date_consistency(make_trips({}), Window("2024-01-09 00:00:00", "2024-02-01 00:00:00", 1)).first()
    assert late["range_check"] == "FAIL"
