"""Sources, cleaning and staging."""

from oracle.base import over

_RAW_TYPES = [
    ("trip_id", "bigint"),
    ("VendorID", "bigint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
]

# One row per raw trip and rule, in rule order; ``ok`` is null when the rule is unknown.
_BROKEN = """
judged AS (
  SELECT trip_id, position, reason, ok
  FROM (
    SELECT trip_id, unnest([
      {'position': 1, 'reason': 'fare_amount > 0', 'ok': fare_amount > 0},
      {'position': 2, 'reason': 'fare_amount < 500', 'ok': fare_amount < 500},
      {'position': 3, 'reason': 'trip_distance > 0', 'ok': trip_distance > 0},
      {'position': 4, 'reason': 'trip_distance < 200', 'ok': trip_distance < 200},
      {'position': 5, 'reason': 'passenger_count >= 1', 'ok': passenger_count >= 1},
      {'position': 6, 'reason': 'passenger_count <= 6', 'ok': passenger_count <= 6},
      {'position': 7, 'reason': 'total_amount > 0', 'ok': total_amount > 0},
      {'position': 8, 'reason': 'pickup in period, start',
       'ok': tpep_pickup_datetime >= TIMESTAMP '2024-01-01'},
      {'position': 9, 'reason': 'pickup in period, end',
       'ok': tpep_pickup_datetime < TIMESTAMP '2024-04-01'},
      {'position': 10, 'reason': 'dropoff after pickup',
       'ok': tpep_dropoff_datetime > tpep_pickup_datetime},
      {'position': 11, 'reason': 'duration <= 180 minutes',
       'ok': date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) <= 180}
    ], recursive := true)
    FROM raw
  )
),
broken AS (
  SELECT trip_id, reason, CASE WHEN ok IS NULL THEN 'null' ELSE 'failed' END AS outcome
  FROM judged
  WHERE ok IS DISTINCT FROM TRUE
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY position) = 1
)
"""


def _with_broken(body: str) -> str:
    return over("raw", body="") + "," + _BROKEN + body


STATEMENTS = {
    "volume": over(
        "raw",
        body="""
        SELECT count(*) AS total_rows,
          CAST(1 AS BIGINT) AS file_count, -- every test table is one file
          min(tpep_pickup_datetime) AS earliest_trip,
          max(tpep_pickup_datetime) AS latest_trip,
          date_diff('day', min(tpep_pickup_datetime), max(tpep_pickup_datetime)) AS date_span_days
        FROM raw
        """,
    ),
    "describe_schema": over(
        "raw",
        body=f"""
        SELECT position, column_name, column_type, null_count,
          if(null_count > 0, 'YES', 'NO') AS nullable
        FROM (SELECT unnest([{", ".join(
            f"{{'position': {i}, 'column_name': '{name}', 'column_type': '{kind}', "
            f"'null_count': count(*) - count({name})}}"
            for i, (name, kind) in enumerate(_RAW_TYPES)
        )}], recursive := true) FROM raw)
        """,
    ),
    "add_features": over("features", body="SELECT * FROM features"),
    "clean": over("clean", body="SELECT * FROM clean"),
    "clean_summary": over(
        "raw",
        "clean",
        body="""
        SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
          round(100.0 * (rows_before - rows_after) / rows_before, 1) AS pct_removed
        FROM (SELECT (SELECT count(*) FROM raw) AS rows_before, (SELECT count(*) FROM clean) AS rows_after)
        """,
    ),
    "rejects": _with_broken("SELECT trip_id, reason, outcome FROM broken"),
    "reject_reasons": _with_broken(
        "SELECT reason, outcome, count(*) AS records FROM broken GROUP BY reason, outcome"
    ),
    "clean_stats": over(
        "clean",
        body="""
        SELECT round(avg(fare_amount), 2) AS avg_fare, round(avg(trip_distance), 2) AS avg_distance_miles,
          round(avg(trip_duration_min), 2) AS avg_duration_min, round(avg(tip_pct), 2) AS avg_tip_pct,
          round(avg(avg_speed_mph), 2) AS avg_speed_mph
        FROM clean
        """,
    ),
    "write_read_clean": over("clean", body="SELECT * FROM clean"),
    "stg_trips": over("stg", body="SELECT * FROM stg"),
    "mart_csv_roundtrip": over("daily", body="SELECT * FROM daily"),
    "pipeline_run": over("daily", body="SELECT * FROM daily"),
    "pipeline_rerun": over("daily", body="SELECT * FROM daily WHERE month(trip_date) <> 2"),
    "daily_by_months": over("daily", body="SELECT * FROM daily"),
    "hourly_by_months": over(
        "stg",
        body="""
        SELECT pickup_hour, time_of_day, count(*) AS total_trips,
          round(avg(fare_amount), 9) AS avg_fare, round(avg(trip_distance), 9) AS avg_distance,
          round(avg(tip_pct), 9) AS avg_tip_pct, round(avg(avg_speed_mph), 9) AS avg_speed_mph
        FROM stg
        GROUP BY ALL
        """,
    ),
    "curved_trips": over(
        "clean",
        body="""
        SELECT PULocationID AS zone, date_trunc('day', tpep_pickup_datetime)::TIMESTAMP AS day,
          count(*) AS trips, round(sum(total_amount), 6) AS revenue
        FROM clean
        WHERE PULocationID BETWEEN 100 AND 120
          AND tpep_pickup_datetime >= TIMESTAMP '2024-02-10' AND tpep_pickup_datetime < TIMESTAMP '2024-03-10'
        GROUP BY ALL
        """,
    ),
    "curved_run": over(
        "clean",
        body="""
        SELECT * EXCLUDE (trip_id, extra, mta_tax),
          CAST(extract(year FROM tpep_pickup_datetime) AS INTEGER) AS pickup_year
        FROM clean
        WHERE PULocationID BETWEEN 100 AND 120
          AND tpep_pickup_datetime >= TIMESTAMP '2024-02-10' AND tpep_pickup_datetime < TIMESTAMP '2024-03-10'
        """,
    ),
    "ingest_new": over("raw", body="SELECT * FROM raw"),
}
