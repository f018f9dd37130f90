"""The named breakdowns of raw and of cleaned trips, all on ``breakdown``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.labels import (
    BAND_TITLES,
    DAY_NAMES,
    MONTH_NAMES,
    PAYMENT_TYPES,
    RATE_CODES,
    VENDORS,
    label,
    short,
)
from ridemart.functions.numeric import mean, percent, rounded, total
from ridemart.operators.breakdown import Cut, breakdown, cut_of, grouped_sets, pivot_counts
from ridemart.operators.columns import TripColumns

_AT = TripColumns()


def _means(at: TripColumns, *parts: str) -> dict[str, Column]:
    """Two-digit means named after the part they measure."""
    return {f"avg_{part}": mean(getattr(at, part)) for part in parts}


# ---- raw trips -------------------------------------------------------------------------


def passenger_distribution(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    return breakdown(
        df.filter(F.col(at.passengers).between(1, 9)),
        [at.passengers],
        {"total_fare": total(at.fare, 0)},
        share="pct",
        bounded_keys=True,
    )


def payment_distribution(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    rate = percent(F.sum(at.tip), F.sum(at.fare))
    out = breakdown(
        df.filter(F.col(at.payment).isin(*PAYMENT_TYPES)),
        [at.payment],
        {**_means(at, "fare", "tip"), "tip_rate_pct": rate},
        share="pct",
        bounded_keys=True,
    )
    return out.withColumn("payment_desc", label(at.payment, PAYMENT_TYPES, "Other"))


def rate_code_distribution(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    out = breakdown(df, [at.rate_code], _means(at, "fare", "distance"), share="pct", bounded_keys=True)
    return out.withColumn("ratecode_desc", label(at.rate_code, RATE_CODES, "Other"))


def vendor_distribution(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    out = breakdown(df, [at.vendor], _means(at, "fare"), share="pct", bounded_keys=True)
    return out.withColumn("vendor_desc", label(at.vendor, VENDORS, "Other"))


def monthly_aggregates(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    return breakdown(
        df,
        {"yr": t.year(at.pickup), "mo": t.month(at.pickup)},
        {**_means(at, "fare", "distance", "tip"), "total_revenue": total(at.total, 0)},
    )


def hourly_profile(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    return breakdown(
        df,
        {"pickup_hour": t.hour(at.pickup)},
        _means(at, "fare", "distance"),
        share="pct_of_day",
        bounded_keys=True,
    )


def weekday_profile(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    out = breakdown(
        df,
        {"dow_number": t.day_of_week(at.pickup)},
        _means(at, "fare", "distance", "tip"),
        share="pct_of_week",
        bounded_keys=True,
    )
    return out.withColumn("day_name", label("dow_number", DAY_NAMES))


def day_type_profile(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    weekend = t.day_of_week(at.pickup).isin(0, 6)
    return breakdown(
        df,
        {"day_type": F.when(weekend, "Weekend").otherwise("Weekday")},
        {**_means(at, "fare", "distance", "tip"), "avg_pickup_hour": mean(F.hour(at.pickup), 1)},
        share="pct",
        bounded_keys=True,
    )


def top_pickups(df: DataFrame, k: int = 10, at: TripColumns = _AT) -> DataFrame:
    """Zones are a city's few hundred ids, so their counts are summed by a window; see ``top_routes``."""
    means = _means(at, "fare", "distance")
    return breakdown(df, [at.origin], means, share="pct", bounded_keys=True, top=k)


def top_dropoffs(df: DataFrame, k: int = 10, at: TripColumns = _AT) -> DataFrame:
    return breakdown(df, [at.destination], _means(at, "fare"), share="pct", bounded_keys=True, top=k)


def top_routes(df: DataFrame, k: int = 10, at: TripColumns = _AT) -> DataFrame:
    """Routes are pairs of zones, so the total is a window over at most zones squared rows."""
    return breakdown(
        df, [at.origin, at.destination], _means(at, "fare", "distance", "tip"), share="pct", bounded_keys=True, top=k
    )


def exploration_cuts(at: TripColumns = _AT, k: int = 10) -> dict[str, Cut]:
    """The breakdowns of the exploration report, by the name they have there."""
    return {
        "passengers": Cut([at.passengers], ["total_fare"], "pct", f"{at.passengers} BETWEEN 1 AND 9"),
        "payments": Cut([at.payment], ["avg_fare", "avg_tip", "tip_rate_pct"], "pct", f"{at.payment} IN ({', '.join(map(str, PAYMENT_TYPES))})"),
        "rate_codes": Cut([at.rate_code], ["avg_fare", "avg_distance"], "pct"),
        "vendors": Cut([at.vendor], ["avg_fare"], "pct"),
        "months": Cut(["yr", "mo"], ["avg_fare", "avg_distance", "avg_tip", "total_revenue"]),
        "hours": Cut(["pickup_hour"], ["avg_fare", "avg_distance"], "pct_of_day"),
        "weekdays": Cut(["dow_number"], ["avg_fare", "avg_distance", "avg_tip"], "pct_of_week"),
        "day_types": Cut(["day_type"], ["avg_fare", "avg_distance", "avg_tip", "avg_pickup_hour"], "pct"),
        "pickup_zones": Cut([at.origin], ["avg_fare", "avg_distance"], "pct", top=k),
        "dropoff_zones": Cut([at.destination], ["avg_fare"], "pct", top=k),
        "routes": Cut([at.origin, at.destination], ["avg_fare", "avg_distance", "avg_tip"], "pct", top=k),
    }


def exploration_groups(df: DataFrame, at: TripColumns = _AT) -> tuple[DataFrame, list[str]]:
    """The groups of all exploration breakdowns in one scan of raw trips, and the names of the keys."""
    weekend = t.day_of_week(at.pickup).isin(0, 6)
    keys = {
        **{c: F.col(c) for c in (at.passengers, at.payment, at.rate_code, at.vendor, at.origin, at.destination)},
        "yr": t.year(at.pickup), "mo": t.month(at.pickup), "pickup_hour": t.hour(at.pickup), "dow_number": t.day_of_week(at.pickup),
        "day_type": F.when(weekend, "Weekend").otherwise("Weekday"),
    }
    measures = {
        **_means(at, "fare", "distance", "tip"),
        "total_fare": total(at.fare, 0),
        "total_revenue": total(at.total, 0),
        "tip_rate_pct": percent(F.sum(at.tip), F.sum(at.fare)),
        "avg_pickup_hour": mean(F.hour(at.pickup), 1),
    }
    return grouped_sets(df, keys, measures, exploration_cuts(at).values(), "trip_count"), list(keys)


def exploration_breakdowns(grouped: DataFrame, keys: Sequence[str], at: TripColumns = _AT) -> dict[str, DataFrame]:
    """Every exploration breakdown, taken from stored groups of all of them."""
    out = {name: cut_of(grouped, keys, cut, "trip_count") for name, cut in exploration_cuts(at).items()}
    out["payments"] = out["payments"].withColumn("payment_desc", label(at.payment, PAYMENT_TYPES, "Other"))
    out["rate_codes"] = out["rate_codes"].withColumn("ratecode_desc", label(at.rate_code, RATE_CODES, "Other"))
    out["vendors"] = out["vendors"].withColumn("vendor_desc", label(at.vendor, VENDORS, "Other"))
    out["weekdays"] = out["weekdays"].withColumn("day_name", label("dow_number", DAY_NAMES))
    return out


# ---- cleaned trips ---------------------------------------------------------------------


def payment_split(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    """Card and cash only; shares are of these two together."""
    out = breakdown(
        df.filter(F.col(at.payment).isin(1, 2)),
        [at.payment],
        _means(at, "fare", "tip"),
        count="trips",
        share="pct",
        bounded_keys=True,
    )
    return out.withColumn("payment_desc", label(at.payment, PAYMENT_TYPES, "Other"))


def band_breakdown(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    out = breakdown(df, ["time_of_day"], _means(at, "fare", "distance", "tip"), count="trips")
    return out.withColumn("label", label("time_of_day", BAND_TITLES))


def weekday_breakdown(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    measures = {**_means(at, "fare", "tip", "distance"), "avg_duration": mean("trip_duration_min")}
    out = breakdown(df, ["pickup_dow"], measures, count="trips")
    return out.withColumn("day", label("pickup_dow", short(DAY_NAMES)))


def monthly_breakdown(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    measures = {**_means(at, "fare", "distance", "tip"), "avg_duration": mean("trip_duration_min")}
    out = breakdown(df, ["pickup_month"], measures)
    return out.withColumn("month_name", label("pickup_month", short(MONTH_NAMES))).drop("trip_count")


def hour_by_weekday(df: DataFrame) -> DataFrame:
    return breakdown(df, ["pickup_dow", "pickup_hour"], {}, count="trips")


def hour_by_weekday_pivot(counts: DataFrame) -> DataFrame:
    """One row per hour, Monday to Sunday across."""
    monday_first = {code: short(DAY_NAMES)[code] for code in (1, 2, 3, 4, 5, 6, 0)}
    return pivot_counts(counts, "pickup_hour", "pickup_dow", "trips", monday_first)


def hour_by_month(df: DataFrame) -> DataFrame:
    return breakdown(df, ["pickup_month", "pickup_hour"], {}, count="trips")


def route_table(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    return breakdown(df, [at.origin, at.destination], _means(at, "fare", "distance"), count="trips")


def kpi_summary(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_trips"),
        total(at.total).alias("total_revenue"),
        mean(at.fare).alias("avg_fare"),
        mean(at.tip).alias("avg_tip"),
        mean(at.distance).alias("avg_distance"),
        mean("trip_duration_min").alias("avg_duration"),
        mean("avg_speed_mph").alias("avg_speed"),
        mean("tip_pct").alias("avg_tip_pct"),
        total(at.congestion).alias("total_congestion"),
        total(at.tolls).alias("total_tolls"),
    )


def insights(df: DataFrame, at: TripColumns = _AT) -> DataFrame:
    """One row of headline facts about cleaned trips, all computed.

    Trips are first reduced to one row per band, payment type and weekday (a few hundred
    at most), and every fact comes from those, so the trips are scanned once.
    """
    cube = df.groupBy("time_of_day", at.payment, "pickup_dow").agg(
        F.count(F.lit(1)).alias("n"), F.sum(at.fare).alias("fares"), F.count(at.fare).alias("fare_rows")
    )

    def trips_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    facts = cube.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_trips"),
        F.sum("fares").alias("fares"),
        F.sum("fare_rows").alias("fare_rows"),
        trips_where(F.col("time_of_day") == "evening_rush").alias("evening"),
        trips_where(F.col("time_of_day") == "morning_rush").alias("morning"),
        trips_where(F.col(at.payment) == 1).alias("card"),
        trips_where(F.col(at.payment).isin(1, 2)).alias("card_or_cash"),
        F.array(
            *[
                F.struct(
                    trips_where(F.col("pickup_dow") == code).alias("n"), F.lit(-code).alias("order")
                )
                for code in DAY_NAMES
            ]
        ).alias("by_day"),
    )
    day_name = lambda day: label(-day["order"], DAY_NAMES)
    seen = F.filter("by_day", lambda d: d["n"] > 0)
    quiet_first = F.transform(seen, lambda d: F.struct((-d["n"]).alias("n"), d["order"].alias("order")))
    return facts.select(
        "total_trips",
        rounded(F.try_divide(F.col("fares"), F.col("fare_rows"))).alias("avg_fare"),
        rounded(F.try_divide(F.col("evening"), F.col("morning")), 1).alias("rush_ratio"),
        percent(F.col("card"), F.col("card_or_cash"), 1).alias("card_share_pct"),
        day_name(F.array_max(seen)).alias("busiest_day"),
        day_name(F.array_max(quiet_first)).alias("quietest_day"),
    )
