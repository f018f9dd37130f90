"""Data quality reports on raw trips, and column tests on any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.numeric import as_col, percent
from ridemart.operators.breakdown import breakdown
from ridemart.operators.columns import TripColumns, Window
from ridemart.operators.rules import Rule, count_matches

# Short column names of the null report.
NULL_COUNT_NAMES = {
    "VendorID": "null_vendor",
    "tpep_pickup_datetime": "null_pickup",
    "tpep_dropoff_datetime": "null_dropoff",
    "passenger_count": "null_passengers",
    "trip_distance": "null_distance",
    "RatecodeID": "null_ratecode",
    "PULocationID": "null_pu_location",
    "DOLocationID": "null_do_location",
    "payment_type": "null_payment",
    "fare_amount": "null_fare",
    "extra": "null_extra",
    "mta_tax": "null_mta_tax",
    "tip_amount": "null_tip",
    "tolls_amount": "null_tolls",
    "total_amount": "null_total",
    "congestion_surcharge": "null_congestion",
}


def validity_checks(at: TripColumns = TripColumns()) -> list[Rule]:
    """Conditions that flag a bad raw trip. Duration is exact, unlike the cleaning rule."""
    return [
        Rule("Negative or zero fare", lambda: as_col(at.fare) <= 0),
        Rule("Fare exceeds $500", lambda: as_col(at.fare) > 500),
        Rule("Zero or negative distance", lambda: as_col(at.distance) <= 0),
        Rule("Distance exceeds 200 miles", lambda: as_col(at.distance) > 200),
        Rule("Invalid passenger count (<=0)", lambda: as_col(at.passengers) <= 0),
        Rule("Invalid passenger count (>6)", lambda: as_col(at.passengers) > 6),
        Rule("Dropoff time <= Pickup time", lambda: as_col(at.dropoff) <= as_col(at.pickup)),
        Rule(
            "Trip duration exceeds 180 minutes",
            lambda: t.elapsed_minutes(at.pickup, at.dropoff) > 180,
        ),
        Rule("Negative tip amount", lambda: as_col(at.tip) < 0),
        Rule("Negative total amount", lambda: as_col(at.total) <= 0),
    ]


# The checks the anomaly scan repeats, with the label it gives them.
ANOMALY_LABELS = {
    "Negative or zero fare": "Fare <= 0",
    "Fare exceeds $500": "Fare > $500",
    "Zero or negative distance": "Trip distance <= 0",
    "Distance exceeds 200 miles": "Trip distance > 200 miles",
    "Invalid passenger count (<=0)": "Passenger count <= 0",
    "Invalid passenger count (>6)": "Passenger count > 6",
    "Dropoff time <= Pickup time": "Dropoff <= Pickup time",
    "Trip duration exceeds 180 minutes": "Trip duration > 3 hours",
}


def null_counts(df: DataFrame, names: Mapping[str, str] = NULL_COUNT_NAMES) -> DataFrame:
    """One row: all rows, their share (100) and the nulls per column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[(F.count(F.lit(1)) - F.count(c)).alias(alias) for c, alias in names.items()],
    ).select(
        "total_rows",
        percent(F.col("total_rows"), F.col("total_rows")).alias("pct"),
        *names.values(),
    )


def column_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Completeness per column in long form, all columns in one scan."""
    columns = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count(c).alias(c) for c in columns])
    long = counted.unpivot("total_rows", columns, "column_name", "non_null")
    missing = F.col("total_rows") - F.col("non_null")
    return long.select(
        "column_name",
        "total_rows",
        "non_null",
        missing.alias("null_count"),
        percent(missing, F.col("total_rows")).alias("null_pct"),
        percent(F.col("non_null"), F.col("total_rows")).alias("completeness_pct"),
    )


def validity(df: DataFrame, checks: Sequence[Rule]) -> DataFrame:
    """Flagged rows per check; a check with none passes."""
    return count_matches(df, checks).withColumn(
        "status", F.when(F.col("records") == 0, "PASS").otherwise("FAIL")
    )


def anomaly_scan(df: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    relabelled = [
        Rule(ANOMALY_LABELS[c.label], c.condition)
        for c in validity_checks(at)
        if c.label in ANOMALY_LABELS
    ]
    return count_matches(df, relabelled, "anomaly_type", "record_count", "pct_of_total")


def quality_score(checks: DataFrame) -> DataFrame:
    """Share of passing checks, from the output of ``validity``."""
    counted = checks.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )
    score = percent(F.col("passed"), F.col("checks_run"), 1)
    return counted.withColumn("quality_score", F.coalesce(score, F.lit(0.0)))


def failed_checks(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("status") == "FAIL").select("check_name", "records", "pct")


def _distinct_small(value: Column) -> Column:
    """Exact distinct count of integers in 0..63 as one 64-bit mask.

    Keeps a single aggregate state per task, where two distinct counts in one query would
    expand every input row.
    """
    one_bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.cast("int"))
    return F.coalesce(F.bit_count(F.bit_or(one_bit)), F.lit(0)).cast("long")


def date_consistency(df: DataFrame, window: Window, at: TripColumns = TripColumns()) -> DataFrame:
    """Pickup range and month coverage against the expected period (its end included)."""
    seen = df.agg(
        F.min(at.pickup).alias("earliest_trip"),
        F.max(at.pickup).alias("latest_trip"),
        _distinct_small(F.month(at.pickup)).alias("distinct_months"),
        _distinct_small(F.dayofmonth(at.pickup)).alias("distinct_days"),
    )
    in_range = (F.col("earliest_trip") >= t.ntz(window.start)) & (F.col("latest_trip") <= t.ntz(window.end))
    return seen.withColumns(
        {
            "range_check": F.when(in_range, "PASS").otherwise("FAIL"),
            "month_coverage": F.when(F.col("distinct_months") == window.months, "PASS").otherwise("FAIL"),
        }
    )


def monthly_counts(df: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    return breakdown(
        df, {"month": t.month(at.pickup)}, {}, count="row_count", share="pct", bounded_keys=True
    )


@dataclass(frozen=True)
class ColumnTest:
    """A declared test; ``failures`` counts what its kind says."""

    kind: str
    column: str
    values: tuple = ()

    def evidence(self) -> Column:
        """True on a row the test has to look at after the scan."""
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "unique":
            return column.isNotNull()
        return ~column.isin(*self.values)

    def failures(self, is_mine: Column) -> Column:
        """Failures from (test, value, n) rows: null rows, repeated values, unlisted values."""
        if self.kind == "not_null":
            return F.coalesce(F.sum(F.when(is_mine, F.col("n"))), F.lit(0))
        if self.kind == "unique":
            return F.count_if(is_mine & (F.col("n") > 1))
        return F.count_if(is_mine)


def not_null(column: str) -> ColumnTest:
    return ColumnTest("not_null", column)


def unique(column: str) -> ColumnTest:
    """Nulls are not repeats."""
    return ColumnTest("unique", column)


def accepted_values(column: str, values: Sequence) -> ColumnTest:
    """Null is not a value."""
    return ColumnTest("accepted_values", column, tuple(values))


# Column tests the staged and mart tables must pass.
TABLE_TESTS = {
    "stg_trips": [
        not_null("pickup_at"),
        not_null("fare_amount"),
        not_null("trip_distance"),
        not_null("passenger_count"),
        accepted_values("passenger_count", [1, 2, 3, 4, 5, 6]),
        accepted_values("payment_type", [1, 2, 3, 4, 5, 6]),
    ],
    "mart_daily_summary": [not_null("trip_date"), unique("trip_date"), not_null("total_trips")],
    "mart_hourly_patterns": [not_null("pickup_hour"), unique("pickup_hour")],
}


def run_tests(df: DataFrame, table: str, tests: Sequence[ColumnTest]) -> DataFrame:
    """All tests of one table in one scan.

    A row emits one small record per test it gives evidence for, usually none; records are
    combined by (test, value) before the shuffle, so a repeated value cannot overload a task.
    """
    evidence = F.array_compact(
        F.array(
            *[
                F.when(
                    test.evidence(),
                    F.struct(F.lit(i).alias("test"), F.col(test.column).cast("string").alias("value")),
                )
                for i, test in enumerate(tests)
            ]
        )
    )
    counted = df.select(F.inline(evidence)).groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"))
    results = counted.agg(
        *[test.failures(F.col("test") == i).alias(f"failures_{i}") for i, test in enumerate(tests)]
    )
    arms = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(test.column).alias("column_name"),
                F.lit(test.kind).alias("test_name"),
                F.col(f"failures_{i}").alias("failures"),
            )
            for i, test in enumerate(tests)
        ]
    )
    return results.select(F.inline(arms)).withColumn(
        "status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    )


def table_tests(
    tables: Mapping[str, DataFrame], tests: Mapping[str, Sequence[ColumnTest]] = TABLE_TESTS
) -> DataFrame:
    """Failures and status of every declared column test."""
    return reduce(DataFrame.unionByName, [run_tests(tables[n], n, ts) for n, ts in tests.items()])
