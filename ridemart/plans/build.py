"""From raw trip files to stored cleaned trips and marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import cleaning, marts
from ridemart.operators.columns import TripColumns, Window
from ridemart.operators.sampling import sample_rows
from ridemart.operators.states import daily_from_states, daily_states, hourly_from_states, hourly_states
from ridemart.sources.layout import splits, write_along_curve
from ridemart.sources.marts import drop_partitions, read_parquet, stored_partitions, write_parquet
from ridemart.sources.trips import read_trips


YEAR, MONTH = "pickup_year", "pickup_month"
DAILY, HOURLY = "mart_daily_summary", "mart_hourly_patterns"


@dataclass(frozen=True)
class Tables:
    cleaned: DataFrame
    stg_trips: DataFrame
    mart_daily_summary: DataFrame
    mart_hourly_patterns: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def derive(raw: DataFrame, window: Window, at: TripColumns = TripColumns()) -> Tables:
    """The four tables as plans over the raw trips; nothing runs yet."""
    return derive_from_clean(cleaning.clean(raw, cleaning.cleaning_rules(window, at), at), at)


def derive_from_clean(cleaned: DataFrame, at: TripColumns = TripColumns()) -> Tables:
    stg = cleaning.stage(cleaned, at)
    return Tables(cleaned, stg, marts.daily_summary(stg), marts.hourly_patterns(stg))


def months_of(window: Window) -> list[tuple[int, int]]:
    """Year and month of every month the window touches."""
    first, last = (dt.datetime.fromisoformat(x) for x in (window.start, window.end))
    last -= dt.timedelta(microseconds=1)
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return [(first.year + (first.month - 1 + k) // 12, (first.month - 1 + k) % 12 + 1) for k in range(count)]


def _in_months(months: Iterable[tuple[int, int]]) -> Column:
    """Whether a stored row lies in one of the months: a filter on partition columns only."""
    each = [(F.col(YEAR) == y) & (F.col(MONTH) == m) for y, m in sorted(months)]
    return reduce(Column.__or__, each, F.lit(False))


def stored_months(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    named = (dict(x.split("=") for x in p.split("/")) for p in stored_partitions(spark, path, 2))
    return {(int(p[YEAR]), int(p[MONTH])) for p in named}


def _drop_months(spark: SparkSession, path: str, months: Iterable[tuple[int, int]]) -> None:
    drop_partitions(spark, path, [f"{YEAR}={y}/{MONTH}={m}" for y, m in months])


def run(
    spark: SparkSession, source: str, target: str, window: Window, rebalance: bool = False, curve: Sequence[str] = ()
) -> Tables:
    """Clean, store, aggregate, store. Staging stays a view over the stored trips.

    Trips are stored by year and month. A run replaces the months of its window (which should be
    whole months) and keeps the others; a month of the window without a row in ``source`` is
    emptied, once the new rows are stored. Beside each mart lie the partial aggregates it
    is folded from: only those of months that this run replaced, or that have none yet, are computed
    from trips. With ``curve``, such as pickup zone and time, the trips of a month lie along a
    space-filling curve of these columns, so that filters on any of them read a part of it; this takes
    three scans of the source and one shuffle.
    """
    trips, months = f"{target}/trips_cleaned", months_of(window)
    pickup = TripColumns().pickup
    rows = (
        cleaning.clean(read_trips(spark, source), cleaning.cleaning_rules(window))
        .drop("extra", "mta_tax")
        .withColumn(YEAR, F.year(pickup))
    )
    seen = Observation()
    observed = rows.observe(seen, *[F.count_if((F.col(YEAR) == y) & (F.col(MONTH) == m)).alias(f"{y}-{m}") for y, m in months])
    if curve:
        borders = splits(rows, curve)
        write_along_curve(observed, trips, curve, [YEAR, MONTH], only_these_partitions=True, borders=borders)
    else:
        write_parquet(observed, trips, partition_by=[YEAR, MONTH], rebalance=rebalance, only_these_partitions=True)
    # Sampling for ranges may count rows twice; only whether there are any is looked at.
    empty = {(y, m) for y, m in months if not seen.get[f"{y}-{m}"]}
    _drop_months(spark, trips, empty)
    cleaned = read_parquet(spark, trips, rows.schema)

    folded = []
    for name, states_of, fold in ((DAILY, daily_states, daily_from_states), (HOURLY, hourly_states, hourly_from_states)):
        states = update_states(cleaned, stored_months(spark, trips), f"{target}/{name}_states", states_of, set(months))
        folded.append(write_parquet(fold(states), f"{target}/{name}"))
    return Tables(cleaned, cleaning.stage(cleaned), *folded)


def update_states(
    cleaned: DataFrame, held: set[tuple[int, int]], path: str, states_of: Callable[[DataFrame], DataFrame], changed: set[tuple[int, int]]
) -> DataFrame:
    """Brings stored states in line with trips stored for months ``held``, ``changed`` of them new; reads them.

    Months that have trips but no states, as after a run that was cut off, count as changed.
    """
    of_months = lambda stale: states_of(cleaning.stage(cleaned.filter(_in_months(stale))))
    return _refreshed(cleaned.sparkSession, held, path, of_months, changed)


def update_samples(
    cleaned: DataFrame, held: set[tuple[int, int]], path: str, n: int, keys: Sequence[str], changed: set[tuple[int, int]], seed: int = 42
) -> DataFrame:
    """The ``n``-row sample of every stored month, of which those of changed months are drawn again.

    ``sample_rows`` of these with the same seed is that of all trips: a row among the n smallest
    hashes of all is among those of its month.
    """

    def of_months(stale: set[tuple[int, int]]) -> DataFrame:
        drawn = [sample_rows(cleaned.filter(_in_months({m})), n, keys, seed) for m in sorted(stale)]
        return reduce(DataFrame.unionByName, drawn, cleaned.limit(0))

    return _refreshed(cleaned.sparkSession, held, path, of_months, changed)


def _refreshed(
    spark: SparkSession, held: set[tuple[int, int]], path: str, of_months: Callable[[set[tuple[int, int]]], DataFrame], changed: set[tuple[int, int]]
) -> DataFrame:
    have = stored_months(spark, path)
    found = of_months(held & (changed | (held - have)))
    write_parquet(found.repartition(YEAR, MONTH), path, partition_by=[YEAR, MONTH], only_these_partitions=True)
    _drop_months(spark, path, have - held)
    return read_parquet(spark, path, found.schema)
