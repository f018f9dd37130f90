"""Daily and hourly marts, and the operators that start from a mart.

A daily mart has one row per calendar day and an hourly mart 24, so windows over a whole
mart order at most some thousand rows; trips themselves never pass through one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.labels import BAND_TITLES, DAY_NAMES, MONTH_NAMES, label, short
from ridemart.functions.numeric import as_col, mean, percent, total
from ridemart.operators.columns import TripColumns


def daily_summary(stg: DataFrame) -> DataFrame:
    """One row per pickup day of the staged trips."""
    in_band = lambda band: F.count_if(F.col("time_of_day") == band)
    return stg.groupBy(t.day_start("pickup_at").alias("trip_date")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        mean("trip_duration_min").alias("avg_duration_min"),
        total("total_amount").alias("total_revenue"),
        mean("tip_pct").alias("avg_tip_pct"),
        in_band("morning_rush").alias("morning_rush_trips"),
        in_band("evening_rush").alias("evening_rush_trips"),
    )


def hourly_patterns(stg: DataFrame) -> DataFrame:
    """One row per pickup hour; speed skips trips without one."""
    return stg.groupBy("pickup_hour", "time_of_day").agg(
        F.count(F.lit(1)).alias("total_trips"),
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        mean("tip_pct").alias("avg_tip_pct"),
        mean("avg_speed_mph").alias("avg_speed_mph"),
    )


def daily_series(
    df: DataFrame, at: Column | str, measures: Mapping[str, Column], day: str = "trip_date", count: str = "total_trips"
) -> DataFrame:
    """Daily mart of any table with a timestamp: count and given measures per day."""
    return df.groupBy(t.day_start(at).alias(day)).agg(
        F.count(F.lit(1)).alias(count), *[m.alias(name) for name, m in measures.items()]
    )


def narrow_daily(cleaned: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    """Five-column daily mart straight from cleaned trips, for when no mart is stored."""
    return daily_series(
        cleaned,
        at.pickup,
        {"avg_fare": mean(at.fare), "total_revenue": total(at.total), "avg_tip_pct": mean("tip_pct")},
    )


def narrow_hourly(cleaned: DataFrame, at: TripColumns = TripColumns()) -> DataFrame:
    """Five-column hourly mart straight from cleaned trips."""
    return cleaned.groupBy("pickup_hour", "time_of_day").agg(
        F.count(F.lit(1)).alias("total_trips"),
        mean(at.fare).alias("avg_fare"),
        mean("avg_speed_mph").alias("avg_speed_mph"),
    )


def daily_calendar(daily: DataFrame, day: str = "trip_date") -> DataFrame:
    """Add month name, day name, weekday number (Monday 0) and weekend flag."""
    return daily.withColumns(
        {
            "month": label(t.month(day), MONTH_NAMES),
            "dow_name": label(t.day_of_week(day), DAY_NAMES),
            "dow_num": t.weekday(day),
            "is_weekend": t.weekday(day).isin(5, 6),
        }
    )


def filter_daily(calendar: DataFrame, months: Sequence[str], day_types: Sequence[str]) -> DataFrame:
    """Keep the chosen months and day types (``Weekday``, ``Weekend``)."""
    wanted = [d == "Weekend" for d in day_types]
    return calendar.filter(F.col("month").isin(*months) & F.col("is_weekend").isin(*wanted))


def daily_kpis(daily: DataFrame) -> DataFrame:
    """Totals, and unweighted means over days; zeros when there is no day."""
    zero = F.lit(0.0)
    return daily.agg(
        F.coalesce(F.sum("total_trips"), F.lit(0)).cast("long").alias("total_trips"),
        F.coalesce(F.sum("total_revenue"), zero).alias("total_revenue"),
        F.coalesce(F.avg("avg_fare"), zero).alias("mean_of_avg_fare"),
        F.coalesce(F.avg("avg_tip_pct"), zero).alias("mean_of_avg_tip_pct"),
    )


def centred_mean(
    df: DataFrame,
    value: str,
    order: str,
    size: int = 7,
    partition_by: Sequence[str] = (),
    name: str = "moving_avg",
) -> DataFrame:
    """Centred rolling mean over min(size, rows) rows; null where the frame is not full.

    An even frame leans back by one row. A single row has no mean.
    """
    series = W.partitionBy(*partition_by)
    ordered = series.orderBy(order)
    frame = ordered.rowsBetween(-(size // 2), (size - 1) // 2)
    full = F.when(F.count(value).over(frame) == size, F.avg(value).over(frame))
    # A series shorter than the frame fills its own frame once, at its middle row.
    length = F.count(F.lit(1)).over(series)
    middle = F.row_number().over(ordered) - 1 == F.floor(length / 2)
    complete = F.count(value).over(series) == length
    once = F.when(middle & complete, F.avg(value).over(series))
    return df.withColumn(name, F.when(length >= size, full).when(length > 1, once))


def revenue_by_month(calendar: DataFrame) -> DataFrame:
    by_month = calendar.groupBy("month").agg(
        total("total_revenue").alias("total_revenue"), F.sum("total_trips").alias("total_trips")
    )
    whole = F.sum("total_revenue").over(W.partitionBy())  # one row per month name
    shared = by_month.withColumn("_all", whole)
    return shared.withColumn("pct", percent(F.col("total_revenue"), F.col("_all"))).drop("_all")


def weekend_split(calendar: DataFrame) -> DataFrame:
    out = calendar.groupBy("is_weekend").agg(F.sum("total_trips").alias("trips"))
    return out.withColumn("label", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday"))


def rush_ratio_of_bands(bands: DataFrame) -> DataFrame:
    """Evening over morning trips from a time-band breakdown; null without morning trips."""
    trips = lambda band: F.sum(F.when(F.col("time_of_day") == band, F.col("trips")))
    return _rush_ratio(bands.agg(trips("evening_rush").alias("evening"), trips("morning_rush").alias("morning")))


def rush_ratio_of_days(daily: DataFrame) -> DataFrame:
    """The same ratio from a daily mart."""
    return _rush_ratio(
        daily.agg(
            F.sum("evening_rush_trips").alias("evening"), F.sum("morning_rush_trips").alias("morning")
        )
    )


def _rush_ratio(sums: DataFrame) -> DataFrame:
    return sums.select(
        F.coalesce("evening", F.lit(0)).cast("long").alias("evening_trips"),
        F.coalesce("morning", F.lit(0)).cast("long").alias("morning_trips"),
    ).withColumn("rush_ratio", F.try_divide(F.col("evening_trips").cast("double"), F.col("morning_trips")))


def rush_melt(daily: DataFrame) -> DataFrame:
    """Morning and evening trips as (date, period, trips) rows, labelled by band."""
    columns = {"morning_rush_trips": "morning_rush", "evening_rush_trips": "evening_rush"}
    long = daily.unpivot("trip_date", list(columns), "period", "trips")
    return long.withColumn(
        "period", label("period", {c: BAND_TITLES[band] for c, band in columns.items()})
    )


def max_normalise(
    df: DataFrame, columns: Sequence[str], otherwise: str = "zero", suffix: str = "_norm"
) -> DataFrame:
    """Divide columns by their maximum. ``df`` is a report: one row per weekday or month.

    When the maximum is not above zero the result is 0 (``otherwise="zero"``) or the value
    itself (``"same"``).
    """
    whole = W.partitionBy()

    def share(column: str) -> Column:
        value, peak = F.col(column).cast("double"), F.max(column).over(whole)
        return F.when(peak > 0, F.try_divide(value, peak)).otherwise(
            F.lit(0.0) if otherwise == "zero" else value
        )

    return df.withColumns({column + suffix: share(column) for column in columns})


def rush_from_hourly(hourly: DataFrame) -> DataFrame:
    """Band totals from the hourly mart; averages are unweighted means over its hours."""
    return hourly.groupBy("time_of_day").agg(
        F.sum("total_trips").alias("trips"),
        F.avg("avg_fare").alias("mean_of_avg_fare"),
        F.avg("avg_tip_pct").alias("mean_of_avg_tip_pct"),
    )


ASSUMED_MPH = 15  # fixed value: speed behind the estimated duration


def weekday_from_daily(daily: DataFrame, day: str = "trip_date") -> DataFrame:
    """Weekday totals from the daily mart, Monday 0; duration is estimated from distance."""
    out = daily.groupBy(t.weekday(day).alias("dow_num")).agg(
        F.sum("total_trips").alias("trips"),
        F.avg("avg_fare").alias("mean_of_avg_fare"),
        F.avg("avg_tip_pct").alias("mean_of_avg_tip_pct"),
        F.avg("avg_distance").alias("mean_of_avg_distance"),
    )
    sunday_based = (F.col("dow_num") + 1) % 7
    return out.withColumns(
        {
            "day": label(sunday_based, short(DAY_NAMES)),
            "est_duration_min": F.col("mean_of_avg_distance") / ASSUMED_MPH * 60,
        }
    )


def zone_totals(routes: DataFrame, zone: str, k: int = 12) -> DataFrame:
    """Largest k zones of one end of the route table; fare is the mean over its routes."""
    return (
        routes.groupBy(as_col(zone).alias("LocationID"))
        .agg(F.sum("trips").alias("trips"), F.avg("avg_fare").alias("mean_of_avg_fare"))
        .orderBy(F.desc("trips"), "LocationID")
        .limit(k)
    )


def route_flow(routes: DataFrame, k: int = 20, at: TripColumns = TripColumns()) -> DataFrame:
    """The k largest routes as (source, target, value) over a numbered list of zones.

    Zones are numbered from 0 by ascending id. After the top-k there are at most 2k of
    them, which bounds the window and both broadcast sides.
    """
    top = (
        routes.orderBy(F.desc("trips"), at.origin, at.destination)
        .limit(k)
        .select(F.col(at.origin).alias("origin"), F.col(at.destination).alias("destination"), "trips")
    )
    zones = top.select(F.col("origin").alias("zone")).union(top.select("destination")).distinct()
    numbered = zones.withColumn("node", (F.row_number().over(W.orderBy("zone")) - 1).cast("long"))
    node_of = lambda end, name: F.broadcast(
        numbered.select(F.col("zone").alias(end), F.col("node").alias(name))
    )
    return (
        top.join(node_of("origin", "source"), "origin")
        .join(node_of("destination", "target"), "destination")
        .select("source", "target", F.col("trips").alias("value"), "origin", "destination")
    )
