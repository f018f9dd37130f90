"""Shared WITH clauses: trip-shaped events, cleaned trips, staged trips, marts."""

from __future__ import annotations

RAW = """
SELECT
  trip_id, VendorID, tpep_pickup_datetime,
  tpep_pickup_datetime + INTERVAL '1' SECOND * ride_s AS tpep_dropoff_datetime,
  passenger_count, trip_distance, RatecodeID, PULocationID, DOLocationID, payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount,
  fare_amount + extra + mta_tax + tip_amount + tolls_amount AS total_amount,
  congestion_surcharge
FROM (
  SELECT *,
    CASE WHEN trip_id % 113 = 0 THEN -base_fare
         WHEN trip_id % 127 = 0 THEN base_fare + 500
         ELSE base_fare END AS fare_amount
  FROM (
    SELECT
      event_id AS trip_id,
      CAST(1 + event_id % 2 AS BIGINT) AS VendorID,
      CASE WHEN event_id % 211 = 0 THEN ts - INTERVAL '8000' DAY
           ELSE ts + INTERVAL '1' DAY * (event_id % 3 * 30) END AS tpep_pickup_datetime,
      CASE WHEN event_id % 97 = 0 THEN 0
           WHEN event_id % 89 = 0 THEN 14400
           ELSE 20 + (event_id * 37) % 5400 END AS ride_s,
      CASE WHEN event_id % 41 = 0 THEN NULL
           ELSE CAST((user_id + event_id) % 8 AS DOUBLE) END AS passenger_count,
      CASE WHEN event_id % 307 = 0 THEN CAST(250 AS DOUBLE)
           ELSE CAST((event_id * 53) % 2500 AS DOUBLE) / 100 END AS trip_distance,
      CASE WHEN event_id % 41 = 0 THEN NULL
           WHEN event_id % 50 = 0 THEN CAST(99 AS DOUBLE)
           ELSE CAST(1 + event_id % 7 AS DOUBLE) END AS RatecodeID,
      CAST(1 + (user_id * 7) % 24 AS BIGINT) AS PULocationID,
      CAST(1 + (event_id * 11) % 17 AS BIGINT) AS DOLocationID,
      CAST(CASE WHEN event_id % 199 = 0 THEN 0
                WHEN event_id % 10 < 6 THEN 1
                WHEN event_id % 10 < 8 THEN 2
                ELSE 3 + event_id % 4 END AS BIGINT) AS payment_type,
      3 + CAST((event_id * 53) % 2500 AS DOUBLE) / 40 + value / 10 AS base_fare,
      CAST(event_id % 3 AS DOUBLE) / 2 AS extra,
      CAST(1 AS DOUBLE) / 2 AS mta_tax,
      CASE WHEN event_id % 151 = 0 THEN CAST(-1 AS DOUBLE)
           ELSE CAST((event_id * 7) % 900 AS DOUBLE) / 100 END AS tip_amount,
      CASE WHEN event_id % 13 = 0 THEN CAST(655 AS DOUBLE) / 100
           ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
      CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(5 AS DOUBLE) / 2 END AS congestion_surcharge
    FROM events
  ) a
) b
"""

# Hour and minutes are named once; the derived columns follow from them.
FEATURES = """
SELECT
  * EXCLUDE (hh, mins),
  hh AS pickup_hour,
  extract(dow FROM tpep_pickup_datetime) AS pickup_dow,
  extract(month FROM tpep_pickup_datetime) AS pickup_month,
  mins AS trip_duration_min,
  CASE WHEN mins > 0 THEN round(trip_distance / (mins / 60.0), 2) END AS avg_speed_mph,
  CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100, 2) ELSE 0 END AS tip_pct,
  CASE WHEN hh IN (7, 8, 9) THEN 'morning_rush'
       WHEN hh IN (16, 17, 18, 19) THEN 'evening_rush'
       ELSE 'off_peak' END AS time_of_day
FROM (
  SELECT *,
    extract(hour FROM tpep_pickup_datetime) AS hh,
    date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS mins
  FROM raw
)
"""

CLEAN = """
SELECT * FROM features
WHERE fare_amount > 0 AND fare_amount < 500
  AND trip_distance > 0 AND trip_distance < 200
  AND passenger_count >= 1 AND passenger_count <= 6
  AND total_amount > 0
  AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01 00:00:00'
  AND tpep_pickup_datetime < TIMESTAMP '2024-04-01 00:00:00'
  AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND trip_duration_min <= 180
"""

STG = """
SELECT
  VendorID AS vendor_id, tpep_pickup_datetime AS pickup_at, tpep_dropoff_datetime AS dropoff_at,
  CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
  CAST(PULocationID AS INTEGER) AS pickup_location_id,
  CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
  CAST(payment_type AS INTEGER) AS payment_type,
  fare_amount, tip_amount, tolls_amount, total_amount, congestion_surcharge,
  pickup_hour, pickup_dow, pickup_month, trip_duration_min, avg_speed_mph, tip_pct, time_of_day
FROM clean
"""

DAILY = """
SELECT
  date_trunc('day', pickup_at)::TIMESTAMP AS trip_date,
  count(*) AS total_trips,
  round(avg(fare_amount), 2) AS avg_fare,
  round(avg(trip_distance), 2) AS avg_distance,
  round(avg(trip_duration_min), 2) AS avg_duration_min,
  round(sum(total_amount), 2) AS total_revenue,
  round(avg(tip_pct), 2) AS avg_tip_pct,
  count(*) FILTER (WHERE time_of_day = 'morning_rush') AS morning_rush_trips,
  count(*) FILTER (WHERE time_of_day = 'evening_rush') AS evening_rush_trips
FROM stg
GROUP BY ALL
"""

HOURLY = """
SELECT
  pickup_hour, time_of_day,
  count(*) AS total_trips,
  round(avg(fare_amount), 2) AS avg_fare,
  round(avg(trip_distance), 2) AS avg_distance,
  round(avg(tip_pct), 2) AS avg_tip_pct,
  round(avg(avg_speed_mph), 2) AS avg_speed_mph
FROM stg
GROUP BY ALL
"""

CALENDAR = """
SELECT *,
  monthname(trip_date) AS month,
  dayname(trip_date) AS dow_name,
  extract(isodow FROM trip_date) - 1 AS dow_num,
  extract(isodow FROM trip_date) >= 6 AS is_weekend
FROM daily
"""

ROUTES = """
SELECT PULocationID, DOLocationID, count(*) AS trips,
  round(avg(fare_amount), 2) AS avg_fare, round(avg(trip_distance), 2) AS avg_distance
FROM clean
GROUP BY ALL
"""

ORDERS_DAILY = """
SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS order_date, count(*) AS total_orders,
  round(avg(o_totalprice), 2) AS avg_price, round(sum(o_totalprice), 2) AS revenue
FROM orders
GROUP BY ALL
"""

_CLAUSES = {
    "raw": (RAW, ()),
    "features": (FEATURES, ("raw",)),
    "clean": (CLEAN, ("features",)),
    "stg": (STG, ("clean",)),
    "daily": (DAILY, ("stg",)),
    "hourly": (HOURLY, ("stg",)),
    "calendar": (CALENDAR, ("daily",)),
    "routes": (ROUTES, ("clean",)),
    "orders_daily": (ORDERS_DAILY, ()),
}


def over(*names: str, body: str) -> str:
    """A statement whose body may read the named clauses."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        text, before = _CLAUSES[name]
        for other in before:
            add(other)
        needed.setdefault(name, text.strip())

    for name in names:
        add(name)
    clauses = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in needed.items())
    return f"WITH {clauses}\n{body.strip()}"
