"""Every registered query: name -> callable(spark, folder of the test tables).

Trip queries run on the trip-shaped view over ``events``; some operators are bound a second
time to ``orders`` or ``lineitem`` to show they depend on no trip column.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions import temporal as t
from ridemart.functions.numeric import rounded, total
from ridemart.operators import (
    cleaning, differences, distinct, heavy, marts, profile, quality, regression, reports, sampling, scoring, states, verify,
)
from ridemart.operators.columns import TripColumns, Window
from ridemart.operators.rules import Rule
from ridemart.plans import build, report_sets
from ridemart.session import shared_folder
from ridemart.sources import layout
from ridemart.sources import marts as storage
from ridemart.sources import trips
from ridemart.sources.schema import DAILY_SUMMARY, EVENTS, LINEITEM, ORDERS
from ridemart.streaming.ingest import ingest_new
from ridemart.streaming.scoring import score_stream

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = Window("2024-01-01 00:00:00", "2024-04-01 00:00:00", 3)
TABLES = {"events": EVENTS, "orders": ORDERS, "lineitem": LINEITEM}
KEY = ["trip_id"]
MEAN_DIGITS = 6  # unrounded means are compared to this many digits
FOLD_DIGITS = 9  # means folded from states are
CURVED_GROUP = 1 << 20  # bytes of a row group, so that small tables have several



class Inputs:
    """The tables one query starts from, planned on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def raw(self) -> DataFrame:
        return trips.trips_from_events(self.table("events"))

    @property
    def raw_with_file(self) -> DataFrame:
        events = self.table("events")
        return trips.trips_from_events(
            events.select("*", F.col("_metadata.file_path").alias(trips.SOURCE_FILE))
        )

    @property
    def rules(self) -> list[Rule]:
        return cleaning.cleaning_rules(WINDOW)

    @property
    def clean(self) -> DataFrame:
        return cleaning.clean(self.raw, self.rules)

    @property
    def stg(self) -> DataFrame:
        return cleaning.stage(self.clean)

    @property
    def keyed_stg(self) -> DataFrame:
        return cleaning.stage(self.clean, carry=KEY)

    @property
    def daily(self) -> DataFrame:
        return marts.daily_summary(self.stg)

    @property
    def hourly(self) -> DataFrame:
        return marts.hourly_patterns(self.stg)

    @property
    def calendar(self) -> DataFrame:
        return marts.daily_calendar(self.daily)

    @property
    def routes(self) -> DataFrame:
        return reports.route_table(self.clean)

    @property
    def orders_daily(self) -> DataFrame:
        return marts.daily_series(
            self.table("orders"),
            "o_orderdate",
            {"avg_price": rounded(F.avg("o_totalprice")), "revenue": total("o_totalprice")},
            day="order_date",
            count="total_orders",
        )


def _round_doubles(df: DataFrame) -> DataFrame:
    """Doubles to a fixed number of digits, for results whose last bits depend on summing order."""
    return df.select(
        *[
            rounded(name, MEAN_DIGITS).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# ---- sources, cleaning, staging --------------------------------------------------------


def _write_read_clean(q: Inputs) -> DataFrame:
    return storage.write_parquet(
        q.clean, shared_folder(q.spark, "trips_cleaned"), partition_by=["pickup_month"]
    )


def _pipeline_run(q: Inputs) -> DataFrame:
    """Raw files of two type variants, as months arrive, cleaned, stored and summarised by day."""
    source, target = shared_folder(q.spark, "raw_trips"), shared_folder(q.spark, "tables")
    for i in range(3):
        part = q.raw.filter(F.col("trip_id") % 3 == i).drop(*KEY)
        if i == 1:
            part = part.withColumns({c: F.col(c).cast("long") for c in ("passenger_count", "RatecodeID")})
            part = part.withColumns({c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")})
        part.write.parquet(f"{source}/part={i}")
    return build.run(q.spark, f"{source}/part=*", target, WINDOW).mart_daily_summary


def _pipeline_rerun(q: Inputs) -> DataFrame:
    """A second run over the same period, whose source has no trip of February any more."""
    source, target = shared_folder(q.spark, "raw_trips"), shared_folder(q.spark, "tables")
    q.raw.drop(*KEY).write.parquet(f"{source}/first")
    q.raw.filter(t.month(TripColumns().pickup) != 2).drop(*KEY).write.parquet(f"{source}/second")
    build.run(q.spark, f"{source}/first", target, WINDOW)
    return build.run(q.spark, f"{source}/second", target, WINDOW).mart_daily_summary


def _by_months(q: Inputs, target: str | None = None) -> build.Tables:
    """Three runs, one for each month; each folds the states of all months stored so far."""
    source, target = shared_folder(q.spark, "raw_trips"), target or shared_folder(q.spark, "tables")
    q.raw.drop(*KEY).write.parquet(source)
    days = [f"2024-0{m}-01 00:00:00" for m in (1, 2, 3, 4)]
    runs = [build.run(q.spark, source, target, Window(*days[k : k + 2], 1)) for k in range(3)]
    return runs[-1]


def _hourly_by_months(q: Inputs) -> DataFrame:
    """The hourly fold of the stored states, its means to nine digits.

    To two digits a mean of an even number of cents lies on a half often, where the order of adding decides.
    """
    target = shared_folder(q.spark, "tables")
    _by_months(q, target)
    return states.hourly_from_states(q.spark.read.parquet(f"{target}/{build.HOURLY}_states"), FOLD_DIGITS)


def _of_zones_and_days(rows: DataFrame) -> DataFrame:
    at = TripColumns()
    zones = F.col(at.origin).between(100, 120)
    first, end = (F.lit(f"2024-0{m}-10 00:00:00").cast("timestamp_ntz") for m in (2, 3))
    return rows.filter(zones & (F.col(at.pickup) >= first) & (F.col(at.pickup) < end))


def _curved_trips(q: Inputs) -> DataFrame:
    """Trips of some zones in some days, from cleaned trips stored along a curve of zone and time."""
    at = TripColumns()
    kept = layout.write_along_curve(
        q.clean, shared_folder(q.spark, "curved_trips"), [at.origin, at.pickup], ["pickup_month"], row_group_bytes=CURVED_GROUP
    )
    return _of_zones_and_days(kept).groupBy(F.col(at.origin).alias("zone"), t.day_start(at.pickup).alias("day")).agg(
        F.count(F.lit(1)).alias("trips"), total(at.total, MEAN_DIGITS).alias("revenue")
    )


def _curved_run(q: Inputs) -> DataFrame:
    """Trips of some zones in some days, from a build that stores them along a curve of zone and time."""
    source, target = shared_folder(q.spark, "raw_trips"), shared_folder(q.spark, "tables")
    q.raw.drop(*KEY).write.parquet(source)
    at = TripColumns()
    return _of_zones_and_days(build.run(q.spark, source, target, WINDOW, curve=[at.origin, at.pickup]).cleaned)


def _mart_csv_roundtrip(q: Inputs) -> DataFrame:
    path = shared_folder(q.spark, "mart_daily_summary_csv")
    storage.export_mart(q.daily, path)
    return storage.read_mart_csv(q.spark, path, DAILY_SUMMARY)


def _ingest_new(q: Inputs) -> DataFrame:
    """Two runs over the same folder; the second finds nothing new."""
    work = shared_folder(q.spark, "ingest")

    def once() -> DataFrame:
        return ingest_new(
            q.spark,
            q.folder,
            f"{work}/trips",
            f"{work}/checkpoint",
            EVENTS,
            trips.trips_from_events,
            file_glob="events.parquet",
        )

    once()
    return once()


SOURCES = {
    "volume": lambda q: trips.volume(q.raw_with_file),
    "describe_schema": lambda q: trips.describe_schema(q.raw, count_nulls=True),
    "add_features": lambda q: cleaning.add_features(q.raw),
    "clean": lambda q: q.clean,
    "clean_summary": lambda q: cleaning.clean_summary(q.raw, q.rules),
    "rejects": lambda q: cleaning.rejects(q.raw, q.rules).select(*KEY, "reason", "outcome"),
    "reject_reasons": lambda q: cleaning.reject_reasons(q.raw, q.rules),
    "clean_stats": lambda q: cleaning.clean_stats(q.clean),
    "write_read_clean": _write_read_clean,
    "stg_trips": lambda q: q.stg,
    "pipeline_run": _pipeline_run,
    "pipeline_rerun": _pipeline_rerun,
    "daily_by_months": lambda q: _by_months(q).mart_daily_summary,
    "hourly_by_months": _hourly_by_months,
    "curved_trips": _curved_trips,
    "curved_run": _curved_run,
    "mart_csv_roundtrip": _mart_csv_roundtrip,
    "ingest_new": _ingest_new,
}

# ---- data quality ----------------------------------------------------------------------


def _tables(q: Inputs) -> dict[str, DataFrame]:
    named = build.derive(q.raw, WINDOW).named()
    return {n: df for n, df in named.items() if n != "cleaned"}


def _lineitem_checks() -> list[Rule]:
    return [
        Rule("quantity over 45", lambda: F.col("l_quantity") > 45),
        Rule("no discount", lambda: F.col("l_discount") <= 0),
        Rule("tax above discount", lambda: F.col("l_tax") > F.col("l_discount")),
        Rule("negative price", lambda: F.col("l_extendedprice") < 0),
    ]




def _distinct_by_days(q: Inputs) -> DataFrame:
    """Distinct values of each month from stored sketches of days, checked with the exact counts."""
    at = TripColumns()
    ride = F.concat_ws("|", at.origin, at.destination, t.hour(at.pickup), at.distance)
    values = {"trips": F.col(*KEY), "rides": ride}
    days = distinct.distinct_states(q.raw, [t.day_start(at.pickup).alias("day")], values)
    kept = storage.write_parquet(days, shared_folder(q.spark, "distinct_days"))
    about = distinct.estimated(distinct.merged(kept, [t.month("day").alias("month")]))
    exact = q.raw.groupBy(t.month(at.pickup).alias("month")).agg(*[F.count_distinct(v).alias(n) for n, v in values.items()])
    near = [distinct.within_bound(f"about_{n}", n).alias(f"{n}_in_bound") for n in values]
    return about.join(exact, "month").select("month", "rows", *values, *near)


QUALITY = {
    "distinct_by_days": _distinct_by_days,
    "dq_null_counts": lambda q: quality.null_counts(q.raw),
    "dq_column_quality": lambda q: quality.column_quality(q.raw, list(quality.NULL_COUNT_NAMES)).orderBy(
        "column_name"
    ),
    "dq_validity": lambda q: quality.validity(q.raw, quality.validity_checks()),
    "anomaly_scan": lambda q: quality.anomaly_scan(q.raw),
    "dq_date_consistency": lambda q: quality.date_consistency(q.raw, WINDOW),
    "dq_date_consistency_clean": lambda q: quality.date_consistency(q.clean, WINDOW),
    "dq_monthly_counts": lambda q: quality.monthly_counts(q.raw).orderBy("month"),
    "dq_score": lambda q: quality.quality_score(quality.validity(q.raw, quality.validity_checks())),
    "dq_score_clean": lambda q: quality.quality_score(quality.validity(q.clean, quality.validity_checks())),
    "dq_failed": lambda q: quality.failed_checks(quality.validity(q.raw, quality.validity_checks())),
    "dq_table_tests": lambda q: quality.table_tests(_tables(q)),
    "lineitem_validity": lambda q: quality.validity(q.table("lineitem"), _lineitem_checks()),
    "lineitem_column_quality": lambda q: quality.column_quality(q.table("lineitem")),
}

# ---- profiling -------------------------------------------------------------------------



def _sample_by_months(q: Inputs) -> DataFrame:
    """A sample kept up by month: March and later arrive once the samples of the months before are stored."""
    work, at = shared_folder(q.spark, "sampled_trips"), TripColumns().pickup
    rows = q.raw.withColumns({build.YEAR: t.year(at), build.MONTH: t.month(at)})
    late = F.col(at) >= F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    before: set[tuple[int, int]] = set()
    for part in (rows.filter(~late), rows.filter(late)):
        storage.write_parquet(part, f"{work}/trips", partition_by=[build.YEAR, build.MONTH], only_these_partitions=True)
        held = build.stored_months(q.spark, f"{work}/trips")
        stored = storage.read_parquet(q.spark, f"{work}/trips", rows.schema)
        drawn = build.update_samples(stored, held, f"{work}/samples", 1_000, KEY, held - before)
        before = held
    return sampling.sample_rows(drawn, 1_000, KEY).drop(build.YEAR, build.MONTH)


def _correlations_by_months(q: Inputs) -> DataFrame:
    """The report on all trips from stored co-moments of months."""
    path = shared_folder(q.spark, "co_moments")
    return profile.correlations_of(storage.write_parquet(profile.correlation_states(q.raw), path))


PROFILES = {
    "sample_by_months": _sample_by_months,
    "correlations_by_months": _correlations_by_months,
    "profile_fare": lambda q: profile.fare_profile(q.raw),
    "profile_distance": lambda q: profile.distance_profile(q.raw),
    "profile_tip": lambda q: profile.tip_profile(q.raw),
    "numeric_summary": lambda q: profile.numeric_summary(q.raw, profile.trip_metrics()),
    "correlations": lambda q: profile.correlations(q.raw, KEY),
    "correlations_sampled": lambda q: profile.correlations(q.raw, KEY, n=2_000),
    "sample_rows": lambda q: sampling.sample_rows(q.raw, 1_000, KEY),
    "scatter_sample": lambda q: profile.scatter_sample(q.clean, KEY),
    "lineitem_numeric_summary": lambda q: profile.numeric_summary(
        q.table("lineitem"),
        {c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
    ),
}

# ---- distributions and breakdowns ------------------------------------------------------

BREAKDOWNS = {
    "heavy_route_hours": lambda q: heavy.top_groups(q.clean, ["PULocationID", "DOLocationID", "pickup_hour"], 20),
    "heavy_doors": lambda q: heavy.top_groups(q.table("lineitem"), ["l_partkey", "l_suppkey"], 25, "line_count"),
    "dist_passengers": lambda q: reports.passenger_distribution(q.raw).orderBy("passenger_count"),
    "dist_payment": lambda q: reports.payment_distribution(q.raw).orderBy("payment_type"),
    "payment_split": lambda q: reports.payment_split(q.clean).orderBy("payment_type"),
    "dist_ratecode": lambda q: reports.rate_code_distribution(q.raw).orderBy(
        F.desc("trip_count"), F.asc_nulls_last("RatecodeID")
    ),
    "dist_vendor": lambda q: reports.vendor_distribution(q.raw).orderBy("VendorID"),
    "monthly_raw": lambda q: reports.monthly_aggregates(q.raw).orderBy("yr", "mo"),
    "hourly_raw": lambda q: reports.hourly_profile(q.raw).orderBy("pickup_hour"),
    "dow_raw": lambda q: reports.weekday_profile(q.raw).orderBy("dow_number"),
    "day_type_raw": lambda q: reports.day_type_profile(q.raw),
    "top_pickup": lambda q: reports.top_pickups(q.raw),
    "top_dropoff": lambda q: reports.top_dropoffs(q.raw),
    "top_routes": lambda q: reports.top_routes(q.raw),
    "time_of_day": lambda q: reports.band_breakdown(q.clean).orderBy(F.desc("trips"), "time_of_day"),
    "dow_clean": lambda q: reports.weekday_breakdown(q.clean).orderBy("pickup_dow"),
    "monthly_clean": lambda q: reports.monthly_breakdown(q.clean).orderBy("pickup_month"),
    "hour_dow": lambda q: reports.hour_by_weekday(q.clean).orderBy("pickup_dow", "pickup_hour"),
    "hour_dow_pivot": lambda q: reports.hour_by_weekday_pivot(reports.hour_by_weekday(q.clean)).orderBy(
        "pickup_hour"
    ),
    "month_hour": lambda q: reports.hour_by_month(q.clean).orderBy("pickup_month", "pickup_hour"),
    "routes_clean": lambda q: q.routes.orderBy(F.desc("trips"), "PULocationID", "DOLocationID"),
    "kpi_summary": lambda q: reports.kpi_summary(q.clean),
}



def _one_scan(q: Inputs) -> DataFrame:
    """All exploration breakdowns, from the groups that one scan has stored, as one long table."""
    numbers = {"day_type": F.col("day_type") == "Weekend"}
    parts = []
    for name, table in report_sets.one_scan_breakdowns(q.raw).items():
        cut = reports.exploration_cuts()[name]
        k1, k2 = ([numbers.get(k, F.col(k)).cast("long") for k in cut.keys] + [F.lit(None).cast("long")])[:2]
        share = F.col(cut.share) if cut.share else F.lit(None).cast("double")
        fare = F.col("avg_fare") if "avg_fare" in cut.measures else F.lit(None).cast("double")
        parts.append(table.select(F.lit(name).alias("report"), k1.alias("k1"), k2.alias("k2"), "trip_count", share.alias("pct"), fare.alias("avg_fare")))
    return reduce(DataFrame.unionByName, parts)


BREAKDOWNS["breakdowns_one_scan"] = _one_scan

# ---- marts and mart-level operators ----------------------------------------------------

_DOW_COLUMNS = ["trips", "avg_fare", "avg_tip", "avg_distance", "avg_duration"]
_MONTH_COLUMNS = ["avg_fare", "avg_distance", "avg_tip", "avg_duration"]


def _stored_or(q: Inputs, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
    return storage.table_or(q.spark, name, derive)


def _view_of(q: Inputs, name: str, mart: DataFrame) -> DataFrame:
    """A stored mart that a reader finds by its name, and so does not derive."""
    view = f"{name}_{uuid.uuid4().hex}"
    storage.save_view(storage.write_parquet(mart, shared_folder(q.spark, name)), view)
    try:
        return _stored_or(q, view, lambda: mart.limit(0))
    finally:
        q.spark.catalog.dropTempView(view)


MARTS = {
    "mart_daily": lambda q: q.daily.orderBy("trip_date"),
    "mart_hourly": lambda q: q.hourly.orderBy("pickup_hour"),
    "daily_fallback": lambda q: _stored_or(
        q, "no_stored_daily_mart", lambda: marts.narrow_daily(q.clean)
    ).orderBy("trip_date"),
    "hourly_fallback": lambda q: _stored_or(
        q, "no_stored_hourly_mart", lambda: marts.narrow_hourly(q.clean)
    ).orderBy("pickup_hour"),
    "daily_stored": lambda q: _view_of(q, "stored_daily_mart", q.daily).orderBy("trip_date"),
    "hourly_stored": lambda q: _view_of(q, "stored_hourly_mart", q.hourly).orderBy("pickup_hour"),
    "daily_calendar": lambda q: q.calendar,
    "daily_filtered": lambda q: marts.filter_daily(q.calendar, ["January", "March"], ["Weekday"]),
    "daily_kpis": lambda q: _round_doubles(marts.daily_kpis(q.daily)),
    "daily_rolling": lambda q: _round_doubles(
        marts.centred_mean(q.daily.select("trip_date", "total_trips"), "total_trips", "trip_date")
    ),
    "revenue_by_month": lambda q: marts.revenue_by_month(q.calendar),
    "weekend_split": lambda q: marts.weekend_split(q.calendar),
    "rush_ratio": lambda q: _round_doubles(marts.rush_ratio_of_bands(reports.band_breakdown(q.clean))),
    "rush_ratio_daily": lambda q: _round_doubles(marts.rush_ratio_of_days(q.daily)),
    "rush_melt": lambda q: marts.rush_melt(q.daily),
    "dow_normalised": lambda q: _round_doubles(
        marts.max_normalise(reports.weekday_breakdown(q.clean).select("pickup_dow", "day", *_DOW_COLUMNS), _DOW_COLUMNS)
    ),
    "monthly_normalised": lambda q: _round_doubles(
        marts.max_normalise(reports.monthly_breakdown(q.clean), _MONTH_COLUMNS, otherwise="same")
    ),
    "rush_from_hourly": lambda q: _round_doubles(marts.rush_from_hourly(q.hourly)),
    "dow_from_daily": lambda q: _round_doubles(marts.weekday_from_daily(q.daily)),
    "zone_pickup12": lambda q: _round_doubles(marts.zone_totals(q.routes, "PULocationID")),
    "zone_dropoff12": lambda q: _round_doubles(marts.zone_totals(q.routes, "DOLocationID")),
    "route_flow": lambda q: marts.route_flow(q.routes),
    "insights": lambda q: reports.insights(q.clean),
    "orders_daily": lambda q: q.orders_daily.orderBy("order_date"),
    "orders_rolling": lambda q: _round_doubles(
        marts.centred_mean(
            q.orders_daily.select("order_date", "total_orders"), "total_orders", "order_date", size=28
        )
    ),
    "orders_status_rolling": lambda q: _round_doubles(
        marts.centred_mean(
            q.table("orders")
            .groupBy("o_orderstatus", t.day_start("o_orderdate").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("total_orders")),
            "total_orders",
            "order_date",
            partition_by=["o_orderstatus"],
        )
    ),
}

# ---- mart verification -----------------------------------------------------------------



def _with_faults(stg: DataFrame) -> DataFrame:
    """Staged trips of which some are lost, some are charged more and some are stored twice."""
    hour = F.col("pickup_hour")
    rows = stg.filter((hour != 3) | (F.col("passenger_count") != 6) | (F.col("payment_type") != 2))
    dearer = F.when((hour == 5) & (F.col("pickup_dow") == 2), F.col("fare_amount") + 1).otherwise(F.col("fare_amount"))
    return rows.withColumn("fare_amount", dearer).union(rows.filter((hour == 11) & (F.col("payment_type") == 4)))


VERIFICATION = {
    "differing_trips": lambda q: differences.differing_keys(q.keyed_stg, _with_faults(q.keyed_stg), KEY),
    "differing_days": lambda q: differences.differing_days(
        q.keyed_stg, _with_faults(q.keyed_stg), KEY, t.day_start("pickup_at")
    ),
    "mart_row_counts": lambda q: storage.list_tables(_tables(q)),
    "first_days": lambda q: verify.first_days(q.daily),
    "last_days": lambda q: verify.last_days(q.daily),
    "hourly_listing": lambda q: verify.hourly_listing(q.hourly),
    "mart_assertions": lambda q: verify.assertions(q.daily, q.hourly),
    "reconcile": lambda q: verify.reconcile(q.stg, q.daily),
    "best_worst": lambda q: verify.best_worst(q.daily),
    "daily_stats": lambda q: verify.daily_stats(q.daily),
    "outlier_days": lambda q: verify.outlier_days(q.daily).orderBy(F.desc("total_trips"), "trip_date"),
    "date_gaps": lambda q: verify.date_gaps(q.daily.filter("trip_date <> TIMESTAMP_NTZ'2024-01-17'")),
    "orders_outlier_days": lambda q: verify.outlier_days(
        q.orders_daily, value="total_orders", columns=("order_date", "total_orders", "revenue")
    ),
    "orders_date_gaps": lambda q: verify.date_gaps(q.orders_daily, day="order_date"),
}

# ---- fare model ------------------------------------------------------------------------


def _training(q: Inputs, n: int | None = regression.TRAINING_ROWS) -> DataFrame:
    return regression.training_rows(q.keyed_stg, KEY, n)


def _split(q: Inputs) -> tuple[DataFrame, DataFrame]:
    """The two parts of one stored sample, so that it is drawn once per query."""
    kept = storage.write_parquet(_training(q), shared_folder(q.spark, "training_rows"))
    return sampling.split(kept, KEY)


def _fitted(q: Inputs, *names: str) -> tuple[regression.Fitted, DataFrame, DataFrame]:
    """Full-size models fitted on the train part, and the two parts."""
    train, test = _split(q)
    candidates = regression.regressors()
    return regression.train_all(train, {n: candidates[n] for n in names or candidates}), train, test


# What a fit must reach on held-out rows to be right, in every registered query.
LEAST_R2 = 0.75


def _line(q: Inputs) -> DataFrame:
    """Rows of both parts, and the conditions that least squares meets on its training rows."""
    fitted, train, test = _fitted(q, "LinearRegression")
    model = fitted.models["LinearRegression"]
    right = regression.least_squares_conditions(model.transform(train))
    held = regression.evaluate(model.transform(test)).select(
        F.col("n_rows").alias("n_test_rows"), (F.col("r2") > LEAST_R2).alias("r2_in_band")
    )
    both = F.lit(fitted.train_rows).cast("long").alias("n_train_rows")
    numbers, found = held.first(), right.first()  # a row of numbers each
    row = [(numbers["n_test_rows"], numbers["r2_in_band"], found["mean_residual_zero"], found["residuals_orthogonal"])]
    shape = "n_test_rows long, r2_in_band boolean, mean_residual_zero boolean, residuals_orthogonal boolean"
    return q.spark.createDataFrame(row, shape).select(both, "*")


def _trees(name: str) -> Callable[[Inputs], DataFrame]:
    def run(q: Inputs) -> DataFrame:
        """Rows of both parts, size of the fit, and whether it is good on held-out rows.

        Of boosting also whether its loss on the training rows never rises.
        """
        fitted, train, test = _fitted(q, name)
        model = fitted.models[name]
        n_trees, depth = regression.tree_size(model)
        boosts = name == "GradientBoosting"
        falls = [F.lit(regression.never_rises(regression.loss_by_round(model, train))).alias("loss_never_rises")] if boosts else []
        return regression.evaluate(model.transform(test)).select(
            F.lit(fitted.train_rows).cast("long").alias("n_train_rows"),
            F.col("n_rows").alias("n_test_rows"),
            F.lit(n_trees).alias("n_trees"),
            F.lit(depth).alias("tree_depth"),
            (F.col("r2") > LEAST_R2).alias("r2_in_band"),
            ((F.col("mae") > 0) & (F.col("mae") <= F.col("rmse"))).alias("mae_up_to_rmse"),
            *falls,
        )

    return run


def _leaderboard(q: Inputs) -> DataFrame:
    """The three candidates, of which the best is saved, loaded and evaluated again."""
    fitted, _, test = _fitted(q)
    board = regression.leaderboard(fitted, test)
    path = shared_folder(q.spark, "best_model")
    regression.save_best(fitted, board, path)
    again = regression.evaluate(regression.load_model(path).transform(test)).first()
    whole = W.partitionBy()  # a row per candidate
    sizes = [regression.tree_size(fitted.models[name]) for name in fitted.models]  # in board order
    n_trees, depth = (F.element_at(F.lit([size[k] for size in sizes]), F.col("position") + 1) for k in (0, 1))
    same = (F.abs(F.col("mae") - again["mae"]) < 1e-9) & (F.abs(F.col("rmse") - again["rmse"]) < 1e-9)
    return board.select(
        "position", "model_type", "n_train_rows", "n_test_rows", n_trees.alias("n_trees"), depth.alias("tree_depth"),
        (F.col("r2") > LEAST_R2).alias("r2_in_band"),
        (F.col("is_best") == (F.col("mae") == F.min("mae").over(whole))).alias("best_has_least_mae"),
        F.count_if("is_best").over(whole).alias("n_best"),
        (~F.col("is_best") | same).alias("reloaded_the_same"),
    )


def _importance(q: Inputs) -> DataFrame:
    model = _fitted(q, "GradientBoosting")[0].models["GradientBoosting"]
    board, (n_trees, depth) = regression.feature_importance(model, q.spark), regression.tree_size(model)
    whole = W.partitionBy()  # a row per feature
    return board.select(
        "feature",
        (F.col("importance") >= 0).alias("not_negative"),
        (F.abs(F.sum("importance").over(whole) - 1) < 1e-9).alias("sum_is_one"),
        (F.col("importance") == F.max("importance").over(whole)).alias("is_largest"),
        F.lit(n_trees).alias("n_trees"),
        F.lit(depth).alias("tree_depth"),
    )


def _scored(scores: DataFrame) -> DataFrame:
    """Scored requests with whether there is a prediction in place of the prediction."""
    return scores.withColumn("has_prediction", F.col("predicted_fare_usd").isNotNull()).drop("predicted_fare_usd")


def _requests(q: Inputs) -> DataFrame:
    """Scoring requests made of raw trips, bad ones included."""
    at = TripColumns()
    return cleaning.add_features(q.raw).select(
        *KEY,
        at.distance,
        F.col(at.passengers).cast("int").alias(at.passengers),
        "pickup_hour",
        "pickup_dow",
        "pickup_month",
        F.col(at.origin).cast("int").alias("pickup_location_id"),
        F.col(at.destination).cast("int").alias("dropoff_location_id"),
        F.col(at.payment).cast("int").alias(at.payment),
        F.col("trip_duration_min").cast("double").alias("trip_duration_min"),
        "avg_speed_mph",
        "time_of_day",
    )


def _score_stream(q: Inputs) -> DataFrame:
    fitted, _, _ = _fitted(q, "LinearRegression")
    arriving = (
        q.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(q.folder)
    )
    streamed = Inputs(q.spark, q.folder)
    streamed.table = lambda name: arriving  # the same plan over a stream of the same file
    work = shared_folder(q.spark, "scored")
    model = fitted.models["LinearRegression"]
    return _scored(score_stream(_requests(streamed), model, f"{work}/scored", f"{work}/checkpoint"))


def _fixed_prediction(q: Inputs) -> DataFrame:
    """Metrics of the formula 3 + 2.5 * distance as a prediction of the fare."""
    rows = q.stg.withColumn("prediction", F.lit(3.0) + F.lit(2.5) * F.col("trip_distance"))
    return _round_doubles(regression.evaluate(rows))


MODEL = {
    "training_rows": _training,
    "encode_band": lambda q: regression.encode_band(q.clean.select(*KEY, "time_of_day")),
    "train_test_split": lambda q: _training(q).select(*KEY).withColumn("is_test", sampling.in_test(KEY)),
    "train_test_split_sampled": lambda q: _training(q, 1_000).select(*KEY).withColumn("is_test", sampling.in_test(KEY)),
    "regression_metrics": _fixed_prediction,
    "lr_metrics": _line,
    "rf_metrics": _trees("RandomForest"),
    "gbt_metrics": _trees("GradientBoosting"),
    "model_leaderboard": _leaderboard,
    "feature_importance": _importance,
    "score_validation": lambda q: scoring.validate(_requests(q)),
    "score_batch": lambda q: _scored(
        scoring.score(_requests(q), _fitted(q, "LinearRegression")[0].models["LinearRegression"])
    ),
    "score_stream": _score_stream,
}

GROUPS = {
    "sources": SOURCES,
    "quality": QUALITY,
    "profiles": PROFILES,
    "breakdowns": BREAKDOWNS,
    "marts": MARTS,
    "verification": VERIFICATION,
    "model": MODEL,
}


def queries() -> dict[str, Query]:
    def bound(plan: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, folder: plan(Inputs(spark, folder))

    return {name: bound(plan) for group in GROUPS.values() for name, plan in group.items()}
