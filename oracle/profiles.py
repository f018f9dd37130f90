"""Numeric profiles, correlations and samples."""

from oracle.base import over


def _points(column: str, points: dict[str, float]) -> str:
    return ", ".join(f"round(quantile_cont({column}, {p}), 2) AS {name}" for name, p in points.items())


_FIVE = {"p01": 0.01, "p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99}


def _summary(metric: str, expression: str, table: str, condition: str) -> str:
    return f"""
    SELECT '{metric}' AS metric, count(*) AS count, round(min(x), 2) AS min_val, {_points("x", _FIVE)},
      round(avg(x), 2) AS mean_val, round(max(x), 2) AS max_val, round(stddev_samp(x), 2) AS std_val
    FROM (SELECT {expression} AS x FROM {table} WHERE {condition})
    """


_MINUTES = "epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0"
_TRIP_METRICS = [
    _summary(c, c, "raw", f"{c} > 0") for c in ("fare_amount", "trip_distance", "tip_amount", "passenger_count")
] + [_summary("trip_duration_min", _MINUTES, "raw", "tpep_dropoff_datetime > tpep_pickup_datetime")]
_LINEITEM_METRICS = [
    _summary(c, c, "lineitem", "true") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
]


def _corr(x: str, y: str, name: str) -> str:
    value = f"round(corr({x}, {y}), 4)"
    return f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END AS {name}"


def _sample(table: str, n: int, condition: str = "true") -> str:
    return f"SELECT * FROM {table} WHERE {condition} ORDER BY md5('42|' || trip_id), trip_id LIMIT {n}"


def _correlations(n: int | None) -> str:
    valid = "fare_amount > 0 AND trip_distance > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime"
    return f"""
    SELECT {_corr("f", "t", "fare_vs_tip")}, {_corr("f", "d", "fare_vs_distance")},
      {_corr("f", "p", "fare_vs_passengers")}, {_corr("f", "h", "fare_vs_hour")},
      {_corr("f", "m", "fare_vs_duration")}, {_corr("t", "d", "tip_vs_distance")},
      {_corr("t", "m", "tip_vs_duration")}, {_corr("d", "m", "distance_vs_duration")}
    FROM (
      SELECT fare_amount AS f, tip_amount AS t, trip_distance AS d, passenger_count AS p,
        hour(tpep_pickup_datetime) AS h, {_MINUTES} AS m
      FROM ({_sample("raw", n, valid) if n else f"SELECT * FROM raw WHERE {valid}"})
    )
    """


STATEMENTS = {
    "profile_fare": over(
        "raw",
        body=f"""
        SELECT count(*) AS total_fares, round(min(fare_amount), 2) AS min_fare,
          {_points("fare_amount", {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75,
                                   "p95": 0.95, "p99": 0.99})},
          round(avg(fare_amount), 2) AS avg_fare, round(max(fare_amount), 2) AS max_fare,
          round(stddev_samp(fare_amount), 2) AS std_fare
        FROM raw WHERE fare_amount > 0
        """,
    ),
    "profile_distance": over(
        "raw",
        body=f"""
        SELECT count(*) AS total, round(min(trip_distance), 2) AS min_dist,
          {_points("trip_distance", {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95})},
          round(avg(trip_distance), 2) AS avg_dist, round(max(trip_distance), 2) AS max_dist
        FROM raw WHERE trip_distance > 0
        """,
    ),
    "profile_tip": over(
        "raw",
        body=f"""
        SELECT count(*) AS total_tips, round(min(tip_amount), 2) AS min_tip,
          {_points("tip_amount", {"p25": 0.25, "median_tip": 0.5, "p75": 0.75})},
          round(avg(tip_amount), 2) AS avg_tip, round(max(tip_amount), 2) AS max_tip
        FROM raw WHERE tip_amount > 0
        """,
    ),
    "numeric_summary": over("raw", body=" UNION ALL ".join(_TRIP_METRICS)),
    "lineitem_numeric_summary": " UNION ALL ".join(_LINEITEM_METRICS).strip(),
    "correlations_by_months": over("raw", body=_correlations(None)),
    "sample_by_months": over("raw", body=_sample("raw", 1_000)),
    "correlations": over("raw", body=_correlations(None)),
    "correlations_sampled": over("raw", body=_correlations(2_000)),
    "sample_rows": over("raw", body=_sample("raw", 1_000)),
    "scatter_sample": over(
        "clean",
        body=f"""
        SELECT fare_amount, trip_distance, tip_amount, time_of_day, pickup_hour, pickup_dow, pickup_month
        FROM ({_sample("clean", 30_000, "fare_amount BETWEEN 3 AND 100 AND trip_distance BETWEEN 0.1 AND 40")})
        """,
    ),
}
