"""Whole reports: the tables a data-quality, exploration, verification or dashboard run shows.

Each function returns named DataFrames. Quantiles and the groups of the exploration report are
computed when the report is made, everything else when it is used. Inputs should be
stored tables (raw files, cleaned trips, marts): every report is one narrow scan of them, so
storing beats caching unless several reports of one small table are drawn at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.operators import marts, profile, quality, reports, verify
from ridemart.operators.columns import Window
from ridemart.plans.build import Tables
from ridemart.session import shared_folder
from ridemart.sources.marts import list_tables, write_parquet
from ridemart.sources.trips import SOURCE_FILE, describe_schema, volume

Report = dict[str, DataFrame]


def quality_report(raw: DataFrame, window: Window) -> Report:
    """Completeness, validity, numeric profiles, date range, months and the overall score."""
    checks = quality.validity(raw, quality.validity_checks())
    return {
        "nulls": quality.null_counts(raw),
        "validity": checks,
        "fare": profile.fare_profile(raw),
        "distance": profile.distance_profile(raw),
        "tip": profile.tip_profile(raw),
        "dates": quality.date_consistency(raw, window),
        "months": quality.monthly_counts(raw).orderBy("month"),
        "score": quality.quality_score(checks),
        "failed": quality.failed_checks(checks),
    }


def one_scan_breakdowns(raw: DataFrame) -> Report:
    """The eleven breakdowns of raw trips: one scan stores their groups, which they are taken from."""
    grouped, keys = reports.exploration_groups(raw)
    return reports.exploration_breakdowns(write_parquet(grouped, shared_folder(raw.sparkSession, "breakdown_groups")), keys)


def exploration_report(raw: DataFrame, keys: Sequence[str]) -> Report:
    """Schema, volume, distributions, time and zone patterns, anomalies and correlations.

    ``raw`` has a ``source_file`` column when it was read with one, which adds ``volume``.
    ``keys`` identify a trip; they make the correlation sample reproducible.
    """
    trip_columns = list(quality.NULL_COUNT_NAMES)
    cuts = one_scan_breakdowns(raw)
    out = {
        "schema": describe_schema(raw),
        "column_quality": quality.column_quality(raw, trip_columns).orderBy("column_name"),
        "numeric_summary": profile.numeric_summary(raw, profile.trip_metrics()),
        "passengers": cuts["passengers"].orderBy("passenger_count"),
        "payments": cuts["payments"].orderBy("payment_type"),
        "rate_codes": cuts["rate_codes"].orderBy(F.desc("trip_count")),
        "vendors": cuts["vendors"].orderBy("VendorID"),
        "months": cuts["months"].orderBy("yr", "mo"),
        "hours": cuts["hours"].orderBy("pickup_hour"),
        "weekdays": cuts["weekdays"].orderBy("dow_number"),
        **{name: cuts[name] for name in ("day_types", "pickup_zones", "dropoff_zones", "routes")},
        "anomalies": quality.anomaly_scan(raw),
        "correlations": profile.correlations(raw, keys),
    }
    if SOURCE_FILE in raw.columns:
        out["volume"] = volume(raw)
    return out


def verification_report(tables: Tables) -> Report:
    """Row counts, first and last days, assertions, reconciliation, extremes, outliers, gaps."""
    stg, daily, hourly = tables.stg_trips, tables.mart_daily_summary, tables.mart_hourly_patterns
    named = {"stg_trips": stg, "mart_daily_summary": daily, "mart_hourly_patterns": hourly}
    return {
        "tables": list_tables(named),
        "column_tests": quality.table_tests(named),
        "first_days": verify.first_days(daily),
        "last_days": verify.last_days(daily),
        "hours": verify.hourly_listing(hourly),
        "assertions": verify.assertions(daily, hourly),
        "reconciliation": verify.reconcile(stg, daily),
        "best_worst": verify.best_worst(daily),
        "daily_stats": verify.daily_stats(daily),
        "outlier_days": verify.outlier_days(daily).orderBy(F.desc("total_trips")),
        "date_gaps": verify.date_gaps(daily),
    }


def dashboard_report(
    tables: Tables,
    keys: Sequence[str],
    months: Sequence[str] | None = None,
    day_types: Sequence[str] = ("Weekday", "Weekend"),
) -> Report:
    """The tables behind every dashboard chart, for the chosen months and day types."""
    clean, hourly = tables.cleaned, tables.mart_hourly_patterns
    calendar = marts.daily_calendar(tables.mart_daily_summary)
    if months is not None:
        calendar = marts.filter_daily(calendar, months, day_types)
    bands, routes = reports.band_breakdown(clean), reports.route_table(clean)
    by_weekday, by_month = reports.weekday_breakdown(clean), reports.monthly_breakdown(clean)
    by_hour = reports.hour_by_weekday(clean)
    return {
        "kpis": reports.kpi_summary(clean),
        "selected_kpis": marts.daily_kpis(calendar),
        "days": calendar.orderBy("trip_date"),
        "moving_average": marts.centred_mean(calendar, "total_trips", "trip_date"),
        "revenue_by_month": marts.revenue_by_month(calendar),
        "weekend_split": marts.weekend_split(calendar),
        "bands": bands.orderBy(F.desc("trips")),
        "rush_ratio": marts.rush_ratio_of_bands(bands),
        "rush_by_day": marts.rush_melt(calendar),
        "payments": reports.payment_split(clean).orderBy("payment_type"),
        "hours": hourly.orderBy("pickup_hour"),
        "heatmap": reports.hour_by_weekday_pivot(by_hour).orderBy("pickup_hour"),
        "hours_by_month": reports.hour_by_month(clean).orderBy("pickup_month", "pickup_hour"),
        "weekdays": marts.max_normalise(by_weekday, ["trips", "avg_fare", "avg_tip", "avg_distance", "avg_duration"]),
        "months": marts.max_normalise(
            by_month, ["avg_fare", "avg_distance", "avg_tip", "avg_duration"], otherwise="same"
        ),
        "scatter": profile.scatter_sample(clean, keys),
        "pickup_zones": marts.zone_totals(routes, "PULocationID"),
        "dropoff_zones": marts.zone_totals(routes, "DOLocationID"),
        "route_flow": marts.route_flow(routes),
        "insights": reports.insights(clean),
    }
