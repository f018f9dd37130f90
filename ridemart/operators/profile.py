"""Numeric profiles and correlations of raw trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.numeric import as_col, rounded, safe_corr
from ridemart.operators.columns import TripColumns
from ridemart.operators.comoments import co_moments, correlation_row
from ridemart.operators.quantiles import summarise
from ridemart.operators.sampling import sample_rows


def positive(column: str) -> Column:
    """The column where it is above zero, null elsewhere."""
    return F.when(F.col(column) > 0, F.col(column))


def trip_metrics(at: TripColumns = TripColumns()) -> dict[str, Column]:
    """Metrics of the numeric summary, each over its own valid rows."""
    ride = F.when(as_col(at.dropoff) > as_col(at.pickup), t.elapsed_minutes(at.pickup, at.dropoff))
    return {
        "fare_amount": positive(at.fare),
        "trip_distance": positive(at.distance),
        "tip_amount": positive(at.tip),
        "passenger_count": positive(at.passengers),
        "trip_duration_min": ride,
    }


def numeric_summary(df: DataFrame, metrics: Mapping[str, Column | str]) -> DataFrame:
    """One row per metric: count, extremes, quantiles, mean and deviation, 2 digits."""
    points = {"p01": 0.01, "p25": 0.25, "median": 0.50, "p75": 0.75, "p99": 0.99}
    out = summarise(df, metrics, points)
    return out.select(
        "metric",
        "count",
        rounded("min").alias("min_val"),
        rounded("p01").alias("p01"),
        rounded("p25").alias("p25"),
        rounded("mean").alias("mean_val"),
        rounded("median").alias("median"),
        rounded("p75").alias("p75"),
        rounded("p99").alias("p99"),
        rounded("max").alias("max_val"),
        rounded("stddev").alias("std_val"),
    )


def _profile(df: DataFrame, column: str, points: Mapping[str, float], names: Mapping[str, str]) -> DataFrame:
    out = summarise(df, {column: positive(column)}, points)
    return out.select(
        *[
            (F.col(source) if source == "count" else rounded(source)).alias(name)
            for source, name in names.items()
        ]
    )


def fare_profile(df: DataFrame, column: str = "fare_amount") -> DataFrame:
    return _profile(
        df,
        column,
        {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99},
        {
            "count": "total_fares",
            "min": "min_fare",
            "p01": "p01",
            "p05": "p05",
            "p25": "p25",
            "mean": "avg_fare",
            "median": "median",
            "p75": "p75",
            "p95": "p95",
            "p99": "p99",
            "max": "max_fare",
            "stddev": "std_fare",
        },
    )


def distance_profile(df: DataFrame, column: str = "trip_distance") -> DataFrame:
    return _profile(
        df,
        column,
        {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95},
        {
            "count": "total",
            "min": "min_dist",
            "p25": "p25",
            "mean": "avg_dist",
            "median": "median",
            "p75": "p75",
            "p95": "p95",
            "max": "max_dist",
        },
    )


def tip_profile(df: DataFrame, column: str = "tip_amount") -> DataFrame:
    return _profile(
        df,
        column,
        {"p25": 0.25, "median": 0.5, "p75": 0.75},
        {
            "count": "total_tips",
            "min": "min_tip",
            "p25": "p25",
            "mean": "avg_tip",
            "median": "median_tip",
            "p75": "p75",
            "max": "max_tip",
        },
    )


# Metric pairs of the correlation report.
CORRELATION_PAIRS = {
    "fare_vs_tip": ("fare", "tip"),
    "fare_vs_distance": ("fare", "distance"),
    "fare_vs_passengers": ("fare", "passengers"),
    "fare_vs_hour": ("fare", "hour"),
    "fare_vs_duration": ("fare", "duration"),
    "tip_vs_distance": ("tip", "distance"),
    "tip_vs_duration": ("tip", "duration"),
    "distance_vs_duration": ("distance", "duration"),
}


def correlations(
    df: DataFrame,
    keys: Sequence[str],
    n: int | None = None,
    seed: int = 42,
    at: TripColumns = TripColumns(),
) -> DataFrame:
    """Pearson correlations of all valid rows in one pass; with ``n``, of a sample of n."""
    valid = _measured_rides(df, at)
    used = valid if n is None else sample_rows(valid, n, keys, seed)
    measured = used.select(*[c.alias(name) for name, c in _ride_metrics(at).items()])
    return measured.agg(*[safe_corr(x, y).alias(name) for name, (x, y) in CORRELATION_PAIRS.items()])


def _measured_rides(df: DataFrame, at: TripColumns) -> DataFrame:
    return df.filter((F.col(at.fare) > 0) & (F.col(at.distance) > 0) & (F.col(at.dropoff) > F.col(at.pickup)))


def _ride_metrics(at: TripColumns) -> dict[str, Column]:
    return {
        "fare": F.col(at.fare),
        "tip": F.col(at.tip),
        "distance": F.col(at.distance),
        "passengers": F.col(at.passengers),
        "hour": t.hour(at.pickup),
        "duration": t.elapsed_minutes(at.pickup, at.dropoff),
    }


def correlation_states(df: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    """Co-moments of the report's pairs by year and month, from which ``correlations_of`` takes any period."""
    metrics = _ride_metrics(at)
    pairs = {name: (metrics[x], metrics[y]) for name, (x, y) in CORRELATION_PAIRS.items()}
    by = [t.year(at.pickup).alias("pickup_year"), t.month(at.pickup).alias("pickup_month")]
    return co_moments(_measured_rides(df, at), by, pairs)


def correlations_of(states: DataFrame) -> DataFrame:
    """The correlation report of the trips that the states stand for."""
    return correlation_row(states, list(CORRELATION_PAIRS))


def scatter_sample(
    df: DataFrame,
    keys: Sequence[str],
    n: int = 80_000,
    m: int = 30_000,
    seed: int = 42,
    at: TripColumns = TripColumns(),
) -> DataFrame:
    """Plot points of plausible trips: at most n, then at most m of those.

    The second draw continues the hash order of the first, so both are one sample of the
    smaller size.
    """
    plausible = df.filter(F.col(at.fare).between(3, 100) & F.col(at.distance).between(0.1, 40))
    columns = [at.fare, at.distance, at.tip, "time_of_day", "pickup_hour", "pickup_dow", "pickup_month"]
    narrow = plausible.select(*keys, *[c for c in columns if c not in keys])
    return sample_rows(narrow, min(n, m), keys, seed).select(*columns)
