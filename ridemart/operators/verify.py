"""Checks that marts are complete, plausible and consistent with the trips behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.numeric import plain_text, rounded

_HEAD_COLUMNS = [
    "trip_date",
    "total_trips",
    "avg_fare",
    "total_revenue",
    "avg_tip_pct",
    "morning_rush_trips",
    "evening_rush_trips",
]


def first_days(daily: DataFrame, n: int = 14) -> DataFrame:
    return daily.select(*_HEAD_COLUMNS).orderBy(F.asc_nulls_last("trip_date")).limit(n)


def last_days(daily: DataFrame, n: int = 14) -> DataFrame:
    return daily.select(*_HEAD_COLUMNS).orderBy(F.desc_nulls_last("trip_date")).limit(n)


def hourly_listing(hourly: DataFrame) -> DataFrame:
    return hourly.select("pickup_hour", "time_of_day", "total_trips", "avg_fare", "avg_speed_mph").orderBy(
        "pickup_hour"
    )


def _all_pass(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """Evaluate aggregate conditions in one pass; unknown (an empty mart) does not pass."""
    status = lambda c: F.when(c, "PASS").otherwise("FAIL")
    row = df.agg(*[status(c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    arms = F.array(
        *[
            F.struct(F.lit(f"{table}: {name}").alias("assertion"), F.col(f"c{i}").alias("status"))
            for i, name in enumerate(checks)
        ]
    )
    return row.select(F.inline(arms))


def assertions(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """Eleven named PASS/FAIL facts about the two marts, one pass over each."""
    rows = F.count(F.lit(1))

    def within(column: str, low: float, high: float) -> Column:
        return (F.min(column) > low) & (F.max(column) < high)

    of_daily = {
        "trip_date is unique": rows == F.count_distinct("trip_date"),
        "no null trip_date": rows == F.count("trip_date"),
        "no null total_trips": rows == F.count("total_trips"),
        "total_trips > 0": F.min("total_trips") > 0,
        "avg_fare in plausible range (0, 200)": within("avg_fare", 0, 200),
    }
    of_hourly = {
        "pickup_hour is unique": rows == F.count_distinct("pickup_hour"),
        "no null pickup_hour": rows == F.count("pickup_hour"),
        "covers all 24 hours": rows == 24,
        "total_trips > 0 for all hours": F.min("total_trips") > 0,
        "avg_fare in plausible range (0, 200)": within("avg_fare", 0, 200),
        "avg_speed_mph in plausible range (0, 100)": within("avg_speed_mph", 0, 100),
    }
    return _all_pass(daily, "daily", of_daily).unionByName(_all_pass(hourly, "hourly", of_hourly))


def reconcile(stg: DataFrame, daily: DataFrame, trip_slack: int = 1, revenue_slack: float = 1000) -> DataFrame:
    """Trips and revenue of the staged rows against the daily mart."""
    of_trips = stg.agg(
        F.lit("staging").alias("side"),
        F.count(F.lit(1)).alias("trips"),
        rounded(F.sum("total_amount")).alias("revenue"),
    )
    of_days = daily.agg(
        F.lit("daily").alias("side"),
        F.sum("total_trips").alias("trips"),
        rounded(F.sum("total_revenue")).alias("revenue"),
    )
    side = lambda name, column: F.max(F.when(F.col("side") == name, F.col(column)))
    both = of_trips.unionByName(of_days).agg(
        side("staging", "trips").alias("staging_trips"),
        side("daily", "trips").alias("daily_trips"),
        side("staging", "revenue").alias("staging_revenue"),
        side("daily", "revenue").alias("daily_revenue"),
    )
    verdict = lambda a, b, slack: F.when(F.abs(F.col(a) - F.col(b)) < slack, "PASS").otherwise("FAIL")
    return both.withColumns(
        {
            "trips_match": verdict("staging_trips", "daily_trips", trip_slack),
            "revenue_match": verdict("staging_revenue", "daily_revenue", revenue_slack),
        }
    )


def best_worst(daily: DataFrame) -> DataFrame:
    """Days with the extreme trips, revenue and fare, as text; ties go to the earlier day."""
    money = lambda c: F.concat(F.lit("$"), plain_text(c))
    wanted = [
        ("Highest Trips", "total_trips", True, F.col("total_trips").cast("string")),
        ("Lowest Trips", "total_trips", False, F.col("total_trips").cast("string")),
        ("Highest Revenue", "total_revenue", True, money("total_revenue")),
        ("Highest Avg Fare", "avg_fare", True, money("avg_fare")),
        ("Lowest Avg Fare", "avg_fare", False, money("avg_fare")),
    ]
    date_text = F.col("trip_date").cast("string")

    def extreme(i: int, column: str, highest: bool, text: Column) -> Column:
        # min_by over (signed value, day): the smallest day wins a tie either way.
        key = F.struct((-F.col(column) if highest else F.col(column)).alias("v"), F.col("trip_date").alias("d"))
        shown = F.struct(date_text.alias("date"), text.alias("value"))
        return F.min_by(shown, F.when(F.col(column).isNotNull(), key)).alias(f"e{i}")

    row = daily.agg(*[extreme(i, c, high, text) for i, (_, c, high, text) in enumerate(wanted)])
    arms = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(f"e{i}.date").alias("date"),
                F.col(f"e{i}.value").alias("value"),
            )
            for i, (name, *_) in enumerate(wanted)
        ]
    )
    return row.select(F.inline(arms)).filter(F.col("date").isNotNull())


def daily_stats(daily: DataFrame) -> DataFrame:
    return daily.agg(
        rounded(F.avg("total_trips"), 0).alias("avg_daily_trips"),
        rounded(F.stddev("total_trips"), 0).alias("std_daily_trips"),
        F.min("total_trips").alias("min_daily_trips"),
        F.max("total_trips").alias("max_daily_trips"),
        rounded(F.avg("total_revenue"), 0).alias("avg_daily_revenue"),
        rounded(F.stddev("total_revenue"), 0).alias("std_daily_revenue"),
    )


def outlier_days(
    daily: DataFrame, k: float = 2, value: str = "total_trips", columns: tuple[str, ...] = ("trip_date", "total_trips", "avg_fare", "total_revenue")
) -> DataFrame:
    """Days more than k sample deviations from the mean, with their z-score."""
    whole = W.partitionBy()  # over a daily mart: one row per day
    scored = daily.withColumns({"_mean": F.avg(value).over(whole), "_dev": F.stddev(value).over(whole)})
    off = F.col(value) - F.col("_mean")
    return scored.filter(F.abs(off) > F.lit(k) * F.col("_dev")).select(
        *columns, rounded(F.try_divide(off, F.col("_dev"))).alias("z_score")
    )


def date_gaps(daily: DataFrame, day: str = "trip_date", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of neighbouring days more than one day apart, and how many days are missing."""
    order = W.partitionBy(*partition_by).orderBy("day")
    paired = daily.select(*partition_by, F.col(day).alias("day")).withColumn(
        "previous", F.lag("day").over(order)
    )
    text = lambda c: F.col(c).cast("string")
    return paired.filter(t.day_distance("previous", "day") > 1).select(
        *partition_by,
        F.concat(text("previous"), F.lit(" → "), text("day")).alias("gap_range"),
        (t.day_distance("previous", "day") - 1).alias("missing_days"),
    )

