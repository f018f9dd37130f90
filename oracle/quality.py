"""Data quality."""

from oracle.base import over

_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "congestion_surcharge",
]
_LINEITEM = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _completeness(table: str, columns: list[str]) -> str:
    pairs = ", ".join(f"{{'column_name': '{c}', 'non_null': count({c})}}" for c in columns)
    return f"""
    SELECT column_name, total_rows, non_null, total_rows - non_null AS null_count,
      round(100.0 * (total_rows - non_null) / total_rows, 2) AS null_pct,
      round(100.0 * non_null / total_rows, 2) AS completeness_pct
    FROM (SELECT count(*) AS total_rows, unnest([{pairs}], recursive := true) FROM {table})
    """


def _flags(table: str, conditions: dict[str, str]) -> str:
    """Rows of (check_name, records, all_rows), one per condition."""
    pairs = ", ".join(
        f"{{'check_name': '{name}', 'records': count(*) FILTER (WHERE {cond})}}"
        for name, cond in conditions.items()
    )
    return f"SELECT count(*) AS all_rows, unnest([{pairs}], recursive := true) FROM {table}"


_EXACT_MINUTES = "epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60.0"
_VALIDITY = {
    "Negative or zero fare": "fare_amount <= 0",
    "Fare exceeds $500": "fare_amount > 500",
    "Zero or negative distance": "trip_distance <= 0",
    "Distance exceeds 200 miles": "trip_distance > 200",
    "Invalid passenger count (<=0)": "passenger_count <= 0",
    "Invalid passenger count (>6)": "passenger_count > 6",
    "Dropoff time <= Pickup time": "tpep_dropoff_datetime <= tpep_pickup_datetime",
    "Trip duration exceeds 180 minutes": f"{_EXACT_MINUTES} > 180",
    "Negative tip amount": "tip_amount < 0",
    "Negative total amount": "total_amount <= 0",
}
_ANOMALIES = {
    "Fare <= 0": "fare_amount <= 0",
    "Fare > $500": "fare_amount > 500",
    "Trip distance <= 0": "trip_distance <= 0",
    "Trip distance > 200 miles": "trip_distance > 200",
    "Passenger count <= 0": "passenger_count <= 0",
    "Passenger count > 6": "passenger_count > 6",
    "Dropoff <= Pickup time": "tpep_dropoff_datetime <= tpep_pickup_datetime",
    "Trip duration > 3 hours": f"{_EXACT_MINUTES} > 180",
}
_LINEITEM_CHECKS = {
    "quantity over 45": "l_quantity > 45",
    "no discount": "l_discount <= 0",
    "tax above discount": "l_tax > l_discount",
    "negative price": "l_extendedprice < 0",
}


def _validity(table: str, conditions: dict[str, str]) -> str:
    return f"""
    SELECT check_name, records, round(100.0 * records / all_rows, 4) AS pct,
      CASE records WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM ({_flags(table, conditions)})
    """


def _score(table: str) -> str:
    return f"""
    SELECT count(*) AS checks_run,
      count(*) FILTER (WHERE status = 'PASS') AS passed,
      count(*) FILTER (WHERE status = 'FAIL') AS failed,
      round(100.0 * count(*) FILTER (WHERE status = 'PASS') / count(*), 1) AS quality_score
    FROM ({_validity(table, _VALIDITY)})
    """


def _date_consistency(table: str) -> str:
    return f"""
    SELECT earliest_trip, latest_trip, distinct_months, distinct_days,
      CASE WHEN earliest_trip >= TIMESTAMP '2024-01-01' AND latest_trip <= TIMESTAMP '2024-04-01'
           THEN 'PASS' ELSE 'FAIL' END AS range_check,
      CASE WHEN distinct_months = 3 THEN 'PASS' ELSE 'FAIL' END AS month_coverage
    FROM (
      SELECT min(tpep_pickup_datetime) AS earliest_trip, max(tpep_pickup_datetime) AS latest_trip,
        count(DISTINCT month(tpep_pickup_datetime)) AS distinct_months,
        count(DISTINCT day(tpep_pickup_datetime)) AS distinct_days
      FROM {table}
    )
    """


_ARMS = []
for _table, _alias, _column in [
    ("stg_trips", "stg", "pickup_at"),
    ("stg_trips", "stg", "fare_amount"),
    ("stg_trips", "stg", "trip_distance"),
    ("stg_trips", "stg", "passenger_count"),
    ("mart_daily_summary", "daily", "trip_date"),
    ("mart_daily_summary", "daily", "total_trips"),
    ("mart_hourly_patterns", "hourly", "pickup_hour"),
]:
    _ARMS.append(
        f"SELECT '{_table}' AS table_name, '{_column}' AS column_name, 'not_null' AS test_name, "
        f"count(*) - count({_column}) AS failures FROM {_alias}"
    )
for _table, _alias, _column in [
    ("mart_daily_summary", "daily", "trip_date"),
    ("mart_hourly_patterns", "hourly", "pickup_hour"),
]:
    _ARMS.append(
        f"SELECT '{_table}', '{_column}', 'unique', count(*) FROM (SELECT {_column} FROM {_alias} "
        f"WHERE {_column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    )
for _column in ["passenger_count", "payment_type"]:
    _ARMS.append(
        f"SELECT 'stg_trips', '{_column}', 'accepted_values', count(DISTINCT {_column}) "
        f"FROM stg WHERE {_column} NOT IN (1, 2, 3, 4, 5, 6)"
    )
_TESTS = " UNION ALL ".join(_ARMS)

STATEMENTS = {
    "distinct_by_days": over(
        "raw",
        body="""
        SELECT extract(month FROM tpep_pickup_datetime) AS month, count(*) AS rows, count(DISTINCT trip_id) AS trips,
          count(DISTINCT (PULocationID, DOLocationID, hour(tpep_pickup_datetime), trip_distance)) AS rides,
          true AS trips_in_bound, true AS rides_in_bound
        FROM raw GROUP BY ALL
        """,
    ),
    "dq_null_counts": over(
        "raw",
        body=f"""
        SELECT count(*) AS total_rows, CAST(100 AS DOUBLE) AS pct,
          {", ".join(
              f"count(*) FILTER (WHERE {column} IS NULL) AS {alias}"
              for column, alias in zip(_COLUMNS, [
                  "null_vendor", "null_pickup", "null_dropoff", "null_passengers", "null_distance",
                  "null_ratecode", "null_pu_location", "null_do_location", "null_payment", "null_fare",
                  "null_extra", "null_mta_tax", "null_tip", "null_tolls", "null_total", "null_congestion",
              ])
          )}
        FROM raw
        """,
    ),
    "dq_column_quality": over("raw", body=_completeness("raw", _COLUMNS)),
    "lineitem_column_quality": _completeness("lineitem", _LINEITEM).strip(),
    "dq_validity": over("raw", body=_validity("raw", _VALIDITY)),
    "lineitem_validity": _validity("lineitem", _LINEITEM_CHECKS).strip(),
    "anomaly_scan": over(
        "raw",
        body=f"""
        SELECT check_name AS anomaly_type, records AS record_count,
          round(100.0 * records / all_rows, 4) AS pct_of_total
        FROM ({_flags("raw", _ANOMALIES)})
        """,
    ),
    "dq_date_consistency": over("raw", body=_date_consistency("raw")),
    "dq_date_consistency_clean": over("clean", body=_date_consistency("clean")),
    "dq_monthly_counts": over(
        "raw",
        body="""
        SELECT month(tpep_pickup_datetime) AS month, count(*) AS row_count,
          round(100.0 * count(*) / (SELECT count(*) FROM raw), 2) AS pct
        FROM raw GROUP BY ALL
        """,
    ),
    "dq_score": over("raw", body=_score("raw")),
    "dq_score_clean": over("clean", body=_score("clean")),
    "dq_failed": over(
        "raw",
        body=f"SELECT check_name, records, pct FROM ({_validity('raw', _VALIDITY)}) WHERE status = 'FAIL'",
    ),
    "dq_table_tests": over(
        "stg",
        "daily",
        "hourly",
        body=f"""
        SELECT *, CASE failures WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_TESTS})
        """,
    ),
}
