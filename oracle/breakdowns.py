"""Distributions and breakdowns."""

from oracle.base import over

# Code tables, as rows to join.
_PAYMENTS = """(VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No Charge'), (4, 'Dispute'), (5, 'Unknown'),
  (6, 'Voided Trip')) names(code, name)"""
_RATES = """(VALUES (1, 'Standard'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau / Westchester'),
  (5, 'Negotiated'), (6, 'Group Ride'), (99, 'Unknown')) names(code, name)"""
_VENDORS = "(VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc.')) names(code, name)"
_BANDS = """(VALUES ('morning_rush', 'Morning Rush'), ('evening_rush', 'Evening Rush'),
  ('off_peak', 'Off-Peak')) names(code, name)"""


def means(*parts: str) -> str:
    """Rounded means under short names."""
    columns = {
        "fare": "fare_amount",
        "distance": "trip_distance",
        "tip": "tip_amount",
        "duration": "trip_duration_min",
    }
    return ", ".join(f"round(avg({columns[p]}), 2) AS avg_{p}" for p in parts)


def share(table: str, name: str = "pct", where: str = "true") -> str:
    return f"round(100.0 * count(*) / (SELECT count(*) FROM {table} WHERE {where}), 2) AS {name}"


_DOW = "extract(dow FROM tpep_pickup_datetime)"

BAND_BODY = f"""
SELECT g.*, name AS label FROM (
  SELECT time_of_day, count(*) AS trips, {means("fare", "distance", "tip")} FROM clean GROUP BY ALL
) g LEFT JOIN {_BANDS} ON code = time_of_day
"""
WEEKDAY_BODY = f"""
SELECT pickup_dow, count(*) AS trips, {means("fare", "tip", "distance", "duration")},
  left(any_value(dayname(tpep_pickup_datetime)), 3) AS day
FROM clean GROUP BY pickup_dow
"""
MONTHLY_BODY = f"""
SELECT pickup_month, {means("fare", "distance", "tip", "duration")},
  left(any_value(monthname(tpep_pickup_datetime)), 3) AS month_name
FROM clean GROUP BY pickup_month
"""

STATEMENTS = {
    "heavy_route_hours": over(
        "clean",
        body="""
        SELECT PULocationID, DOLocationID, pickup_hour, count(*) AS trip_count FROM clean
        GROUP BY ALL ORDER BY trip_count DESC, PULocationID, DOLocationID, pickup_hour LIMIT 20
        """,
    ),
    "heavy_doors": """
        SELECT l_partkey, l_suppkey, count(*) AS line_count FROM lineitem
        GROUP BY ALL ORDER BY line_count DESC, l_partkey, l_suppkey LIMIT 25
        """.strip(),
    "dist_passengers": over(
        "raw",
        body=f"""
        SELECT passenger_count, count(*) AS trip_count,
          {share("raw", where="passenger_count BETWEEN 1 AND 9")}, round(sum(fare_amount)) AS total_fare
        FROM raw WHERE passenger_count BETWEEN 1 AND 9 GROUP BY passenger_count
        """,
    ),
    "dist_payment": over(
        "raw",
        body=f"""
        SELECT payment_type, any_value(name) AS payment_desc, count(*) AS trip_count,
          {share("raw", where="payment_type BETWEEN 1 AND 6")}, {means("fare", "tip")},
          round(100.0 * sum(tip_amount) / nullif(sum(fare_amount), 0), 2) AS tip_rate_pct
        FROM raw JOIN {_PAYMENTS} ON code = payment_type GROUP BY payment_type
        """,
    ),
    "payment_split": over(
        "clean",
        body=f"""
        SELECT payment_type, any_value(name) AS payment_desc, count(*) AS trips,
          {share("clean", where="payment_type IN (1, 2)")}, {means("fare", "tip")}
        FROM clean JOIN {_PAYMENTS} ON code = payment_type
        WHERE payment_type <= 2 GROUP BY payment_type
        """,
    ),
    "dist_ratecode": over(
        "raw",
        body=f"""
        SELECT RatecodeID, coalesce(any_value(name), 'Other') AS ratecode_desc, count(*) AS trip_count,
          {share("raw")}, {means("fare", "distance")}
        FROM raw LEFT JOIN {_RATES} ON code = RatecodeID GROUP BY RatecodeID
        """,
    ),
    "dist_vendor": over(
        "raw",
        body=f"""
        SELECT VendorID, coalesce(any_value(name), 'Other') AS vendor_desc, count(*) AS trip_count,
          {share("raw")}, {means("fare")}
        FROM raw LEFT JOIN {_VENDORS} ON code = VendorID GROUP BY VendorID
        """,
    ),
    "monthly_raw": over(
        "raw",
        body=f"""
        SELECT year(tpep_pickup_datetime) AS yr, month(tpep_pickup_datetime) AS mo, count(*) AS trip_count,
          {means("fare", "distance", "tip")}, round(sum(total_amount)) AS total_revenue
        FROM raw GROUP BY ALL
        """,
    ),
    "hourly_raw": over(
        "raw",
        body=f"""
        SELECT hour(tpep_pickup_datetime) AS pickup_hour, count(*) AS trip_count,
          {share("raw", "pct_of_day")}, {means("fare", "distance")}
        FROM raw GROUP BY ALL
        """,
    ),
    "dow_raw": over(
        "raw",
        body=f"""
        SELECT {_DOW} AS dow_number, dayname(any_value(tpep_pickup_datetime)) AS day_name,
          count(*) AS trip_count, {share("raw", "pct_of_week")}, {means("fare", "distance", "tip")}
        FROM raw GROUP BY {_DOW}
        """,
    ),
    "day_type_raw": over(
        "raw",
        body=f"""
        SELECT CASE WHEN {_DOW} IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
          count(*) AS trip_count, {share("raw")}, {means("fare", "distance", "tip")},
          round(avg(hour(tpep_pickup_datetime)), 1) AS avg_pickup_hour
        FROM raw GROUP BY ALL
        """,
    ),
    "top_pickup": over(
        "raw",
        body=f"""
        SELECT PULocationID, count(*) AS trip_count, {share("raw")}, {means("fare", "distance")}
        FROM raw GROUP BY PULocationID ORDER BY trip_count DESC, PULocationID LIMIT 10
        """,
    ),
    "top_dropoff": over(
        "raw",
        body=f"""
        SELECT DOLocationID, count(*) AS trip_count, {share("raw")}, {means("fare")}
        FROM raw GROUP BY DOLocationID ORDER BY trip_count DESC, DOLocationID LIMIT 10
        """,
    ),
    "top_routes": over(
        "raw",
        body=f"""
        SELECT PULocationID, DOLocationID, count(*) AS trip_count, {share("raw")},
          {means("fare", "distance", "tip")}
        FROM raw GROUP BY PULocationID, DOLocationID
        ORDER BY trip_count DESC, PULocationID, DOLocationID LIMIT 10
        """,
    ),
    "time_of_day": over("clean", body=BAND_BODY),
    "dow_clean": over("clean", body=WEEKDAY_BODY),
    "monthly_clean": over("clean", body=MONTHLY_BODY),
    "hour_dow": over(
        "clean", body="SELECT pickup_dow, pickup_hour, count(*) AS trips FROM clean GROUP BY ALL"
    ),
    "hour_dow_pivot": over(
        "clean",
        body=f"""
        SELECT pickup_hour, {", ".join(
            f"nullif(count(*) FILTER (WHERE pickup_dow = {code}), 0) AS {name}"
            for code, name in [(1, "Mon"), (2, "Tue"), (3, "Wed"), (4, "Thu"), (5, "Fri"), (6, "Sat"), (0, "Sun")]
        )}
        FROM clean GROUP BY pickup_hour
        """,
    ),
    "month_hour": over(
        "clean", body="SELECT pickup_month, pickup_hour, count(*) AS trips FROM clean GROUP BY ALL"
    ),
    "routes_clean": over("routes", body="SELECT * FROM routes"),
    "kpi_summary": over(
        "clean",
        body=f"""
        SELECT count(*) AS total_trips, round(sum(total_amount), 2) AS total_revenue,
          {means("fare", "tip", "distance", "duration")}, round(avg(avg_speed_mph), 2) AS avg_speed,
          round(avg(tip_pct), 2) AS avg_tip_pct, round(sum(congestion_surcharge), 2) AS total_congestion,
          round(sum(tolls_amount), 2) AS total_tolls
        FROM clean
        """,
    ),
}


def _cut(report: str, k1: str, k2: str = "NULL", where: str = "TRUE", pct: bool = True, fare: bool = True, top: int | None = None) -> str:
    share = "round(100.0 * count(*) / sum(count(*)) OVER (), 2)" if pct else "CAST(NULL AS DOUBLE)"
    mean = "round(avg(fare_amount), 2)" if fare else "CAST(NULL AS DOUBLE)"
    best = f"ORDER BY trip_count DESC, k1 NULLS LAST, k2 NULLS LAST LIMIT {top}" if top else ""
    return f"""(SELECT '{report}' AS report, CAST({k1} AS BIGINT) AS k1, CAST({k2} AS BIGINT) AS k2,
      count(*) AS trip_count, {share} AS pct, {mean} AS avg_fare
      FROM raw WHERE {where} GROUP BY ALL {best})"""


_AT = "tpep_pickup_datetime"
STATEMENTS["breakdowns_one_scan"] = over(
    "raw",
    body=" UNION ALL ".join(
        [
            _cut("passengers", "passenger_count", where="passenger_count BETWEEN 1 AND 9", fare=False),
            _cut("payments", "payment_type", where="payment_type BETWEEN 1 AND 6"),
            _cut("rate_codes", "RatecodeID"),
            _cut("vendors", "VendorID"),
            _cut("months", f"year({_AT})", f"month({_AT})", pct=False),
            _cut("hours", f"hour({_AT})"),
            _cut("weekdays", f"dayofweek({_AT})"),
            _cut("day_types", f"dayofweek({_AT}) IN (0, 6)"),
            _cut("pickup_zones", "PULocationID", top=10),
            _cut("dropoff_zones", "DOLocationID", top=10),
            _cut("routes", "PULocationID", "DOLocationID", top=10),
        ]
    ),
)
