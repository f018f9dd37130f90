"""Cleaning rules, trip features, and the reports about what cleaning removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.labels import time_band
from ridemart.functions.numeric import as_col, half_even_int, mean, percent, rounded
from ridemart.operators.columns import TripColumns, Window
from ridemart.operators.rules import (
    Rule,
    above,
    all_hold,
    at_least,
    at_most,
    below,
    keep,
    mark_broken,
)

# Limits a trip must respect to be kept.
MAX_FARE = 500
MAX_MILES = 200
MAX_PASSENGERS = 6
MAX_MINUTES = 180


def cleaning_rules(window: Window, at: TripColumns = TripColumns()) -> list[Rule]:
    """What a usable trip satisfies. Duration counts minute marks crossed."""
    return [
        above(at.fare, 0),
        below(at.fare, MAX_FARE),
        above(at.distance, 0),
        below(at.distance, MAX_MILES),
        at_least(at.passengers, 1),
        at_most(at.passengers, MAX_PASSENGERS),
        above(at.total, 0),
        Rule("pickup in period, start", lambda: as_col(at.pickup) >= t.ntz(window.start)),
        Rule("pickup in period, end", lambda: as_col(at.pickup) < t.ntz(window.end)),
        Rule("dropoff after pickup", lambda: as_col(at.dropoff) > as_col(at.pickup)),
        Rule(
            f"duration <= {MAX_MINUTES} minutes",
            lambda: t.minute_boundaries(at.pickup, at.dropoff) <= MAX_MINUTES,
        ),
    ]


def add_features(df: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    """Add hour, weekday, month, minutes, speed, tip percent and time band."""
    timed = df.withColumns(
        {
            "pickup_hour": t.hour(at.pickup),
            "pickup_dow": t.day_of_week(at.pickup),
            "pickup_month": t.month(at.pickup),
            "trip_duration_min": t.minute_boundaries(at.pickup, at.dropoff),
        }
    )
    hours = F.col("trip_duration_min") / F.lit(60.0)
    return timed.withColumns(
        {
            "avg_speed_mph": F.when(
                F.col("trip_duration_min") > 0, rounded(F.try_divide(F.col(at.distance), hours))
            ),
            "tip_pct": F.when(
                F.col(at.fare) > 0,
                rounded(F.try_divide(F.col(at.tip), F.col(at.fare)) * F.lit(100.0)),
            ).otherwise(0.0),
            "time_of_day": time_band("pickup_hour"),
        }
    )


def clean(df: DataFrame, rules: Sequence[Rule], at: TripColumns = TripColumns()) -> DataFrame:
    """Rows every rule accepts, with features. A narrow job: filter and projection only."""
    return add_features(keep(df, rules), at)


def clean_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows before and after cleaning, removed rows and percent, from one scan of the raw rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(all_hold(rules)).alias("rows_after")
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counted.select(
        "rows_before",
        "rows_after",
        removed.alias("rows_removed"),
        percent(removed, F.col("rows_before"), 1).alias("pct_removed"),
    )


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows cleaning drops, each with the first rule it breaks and whether that was a null."""
    dropped = df.filter(~F.coalesce(all_hold(rules), F.lit(False)))
    return mark_broken(dropped, rules)


def reject_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return rejects(df, rules).groupBy("reason", "outcome").agg(F.count(F.lit(1)).alias("records"))


def clean_stats(df: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    return df.agg(
        mean(at.fare).alias("avg_fare"),
        mean(at.distance).alias("avg_distance_miles"),
        mean("trip_duration_min").alias("avg_duration_min"),
        mean("tip_pct").alias("avg_tip_pct"),
        mean("avg_speed_mph").alias("avg_speed_mph"),
    )


def stage(df: DataFrame, at: TripColumns = TripColumns(), carry: Sequence[str] = ()) -> DataFrame:
    """Rename and cast cleaned trips to the names the marts use.

    ``carry`` lists further columns to keep as they are, such as a row key.
    """
    return df.select(
        *carry,
        F.col(at.vendor).alias("vendor_id"),
        F.col(at.pickup).alias("pickup_at"),
        F.col(at.dropoff).alias("dropoff_at"),
        half_even_int(at.passengers).alias("passenger_count"),
        F.col(at.distance).alias("trip_distance"),
        F.col(at.origin).cast("int").alias("pickup_location_id"),
        F.col(at.destination).cast("int").alias("dropoff_location_id"),
        F.col(at.payment).cast("int").alias("payment_type"),
        F.col(at.fare).alias("fare_amount"),
        F.col(at.tip).alias("tip_amount"),
        F.col(at.tolls).alias("tolls_amount"),
        F.col(at.total).alias("total_amount"),
        F.col(at.congestion).alias("congestion_surcharge"),
        "pickup_hour",
        "pickup_dow",
        "pickup_month",
        "trip_duration_min",
        "avg_speed_mph",
        "tip_pct",
        "time_of_day",
    )
