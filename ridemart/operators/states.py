"""Mergeable partial aggregates of staged trips, and the marts folded from them.

A state row holds the number of trips of a group and of each measure the number of values and
their sum. States of disjoint trips merge by addition, so marts of any period come from the
states of its months, and only months whose trips changed have to be read again. Daily states
are by day, hourly ones by month, hour and band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.numeric import rounded

BANDS = ["morning_rush", "evening_rush"]
#: Staged columns whose averages or sums the marts show, by the name they have in a state.
MEASURES = {
    "fare": "fare_amount",
    "distance": "trip_distance",
    "duration": "trip_duration_min",
    "revenue": "total_amount",
    "tip_pct": "tip_pct",
    "speed": "avg_speed_mph",
}


def _parts() -> list[Column]:
    """What a state holds; null values of a measure count for none."""
    return [
        F.count(F.lit(1)).alias("trips"),
        *[F.count(c).alias(f"n_{name}") for name, c in MEASURES.items()],
        *[F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(f"sum_{name}") for name, c in MEASURES.items()],
        *[F.count_if(F.col("time_of_day") == band).alias(f"trips_{band}") for band in BANDS],
    ]


def _month(at: str) -> list[Column]:
    return [t.year(at).alias("pickup_year"), t.month(at).alias("pickup_month")]


def daily_states(stg: DataFrame) -> DataFrame:
    """One state row for each day of staged trips, with its year and month."""
    found = stg.groupBy(t.day_start("pickup_at").alias("trip_date")).agg(*_parts())
    return found.select("*", *_month("trip_date"))


def hourly_states(stg: DataFrame) -> DataFrame:
    """One state row for each month, hour and band of staged trips."""
    return stg.groupBy(*_month("pickup_at"), "pickup_hour", "time_of_day").agg(*_parts())


def merged(states: DataFrame) -> DataFrame:
    """States of the same group added up."""
    parts = [c for c in states.columns if c.startswith(("trips", "n_", "sum_"))]
    return states.groupBy(*[c for c in states.columns if c not in parts]).agg(*[F.sum(c).alias(c) for c in parts])


def _mean(measure: str, digits: int = 2) -> Column:
    return rounded(F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}")), digits)


def _total(measure: str) -> Column:
    return rounded(F.when(F.sum(f"n_{measure}") > 0, F.sum(f"sum_{measure}")))


def daily_from_states(states: DataFrame) -> DataFrame:
    """The daily mart of the trips that the states stand for."""
    return states.groupBy("trip_date").agg(
        F.sum("trips").alias("total_trips"),
        _mean("fare").alias("avg_fare"),
        _mean("distance").alias("avg_distance"),
        _mean("duration").alias("avg_duration_min"),
        _total("revenue").alias("total_revenue"),
        _mean("tip_pct").alias("avg_tip_pct"),
        *[F.sum(f"trips_{band}").alias(f"{band}_trips") for band in BANDS],
    )


def hourly_from_states(states: DataFrame, digits: int = 2) -> DataFrame:
    """The hourly mart of the trips that the states stand for, means to so many digits."""
    return states.groupBy("pickup_hour", "time_of_day").agg(
        F.sum("trips").alias("total_trips"),
        _mean("fare", digits).alias("avg_fare"),
        _mean("distance", digits).alias("avg_distance"),
        _mean("tip_pct", digits).alias("avg_tip_pct"),
        _mean("speed", digits).alias("avg_speed_mph"),
    )
