"""Marts and the operators that start from one."""

from oracle.base import over
from oracle.breakdowns import BAND_BODY, MONTHLY_BODY, WEEKDAY_BODY


def _normalised(body: str, columns: list[str]) -> str:
    shares = ", ".join(
        f"round(CASE WHEN max({c}) OVER () > 0 THEN CAST({c} AS DOUBLE) / max({c}) OVER () END, 6) AS {c}_norm"
        for c in columns
    )
    return f"SELECT *, {shares} FROM ({body})"


def _zones(side: str) -> str:
    return f"""
    SELECT {side} AS LocationID, CAST(sum(trips) AS BIGINT) AS trips,
      round(avg(avg_fare), 6) AS mean_of_avg_fare
    FROM routes GROUP BY {side} ORDER BY trips DESC, LocationID LIMIT 12
    """


def _rolling(value: str, day: str, before: int, after: int, partition: str = "") -> str:
    """Centred mean of a full frame of before + 1 + after rows."""
    frame = f"({partition} ORDER BY {day} ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return f"""
    CASE WHEN count(*) OVER {frame} = {before + after + 1}
         THEN round(avg({value}) OVER {frame}, 6) END AS moving_avg
    """


STATEMENTS = {
    "mart_daily": over("daily", body="SELECT * FROM daily"),
    "mart_hourly": over("hourly", body="SELECT * FROM hourly"),
    "daily_stored": over("daily", body="SELECT * FROM daily"),
    "hourly_stored": over("hourly", body="SELECT * FROM hourly"),
    "daily_fallback": over(
        "daily", body="SELECT trip_date, total_trips, avg_fare, total_revenue, avg_tip_pct FROM daily"
    ),
    "hourly_fallback": over(
        "hourly", body="SELECT pickup_hour, time_of_day, total_trips, avg_fare, avg_speed_mph FROM hourly"
    ),
    "daily_calendar": over("calendar", body="SELECT * FROM calendar"),
    "daily_filtered": over(
        "calendar",
        body="SELECT * FROM calendar WHERE month IN ('January', 'March') AND NOT is_weekend",
    ),
    "daily_kpis": over(
        "daily",
        body="""
        SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips, round(sum(total_revenue), 6) AS total_revenue,
          round(avg(avg_fare), 6) AS mean_of_avg_fare, round(avg(avg_tip_pct), 6) AS mean_of_avg_tip_pct
        FROM daily
        """,
    ),
    "daily_rolling": over(
        "daily",
        body=f"SELECT trip_date, total_trips, {_rolling('total_trips', 'trip_date', 3, 3)} FROM daily",
    ),
    "revenue_by_month": over(
        "calendar",
        body="""
        SELECT month, round(sum(total_revenue), 2) AS total_revenue,
          CAST(sum(total_trips) AS BIGINT) AS total_trips,
          round(100.0 * round(sum(total_revenue), 2) / (SELECT sum(total_revenue) FROM calendar), 2) AS pct
        FROM calendar GROUP BY month
        """,
    ),
    "weekend_split": over(
        "calendar",
        body="""
        SELECT is_weekend, CAST(sum(total_trips) AS BIGINT) AS trips,
          if(is_weekend, 'Weekend', 'Weekday') AS label
        FROM calendar GROUP BY is_weekend
        """,
    ),
    "rush_ratio": over(
        "clean",
        body="""
        SELECT count(*) FILTER (WHERE time_of_day = 'evening_rush') AS evening_trips,
          count(*) FILTER (WHERE time_of_day = 'morning_rush') AS morning_trips,
          round(CAST(count(*) FILTER (WHERE time_of_day = 'evening_rush') AS DOUBLE)
            / nullif(count(*) FILTER (WHERE time_of_day = 'morning_rush'), 0), 6) AS rush_ratio
        FROM clean
        """,
    ),
    "rush_ratio_daily": over(
        "daily",
        body="""
        SELECT CAST(sum(evening_rush_trips) AS BIGINT) AS evening_trips,
          CAST(sum(morning_rush_trips) AS BIGINT) AS morning_trips,
          round(CAST(sum(evening_rush_trips) AS DOUBLE) / nullif(sum(morning_rush_trips), 0), 6) AS rush_ratio
        FROM daily
        """,
    ),
    "rush_melt": over(
        "daily",
        body="""
        SELECT trip_date, 'Morning Rush' AS period, morning_rush_trips AS trips FROM daily
        UNION ALL
        SELECT trip_date, 'Evening Rush', evening_rush_trips FROM daily
        """,
    ),
    "dow_normalised": over(
        "clean",
        body=_normalised(WEEKDAY_BODY, ["trips", "avg_fare", "avg_tip", "avg_distance", "avg_duration"]),
    ),
    "monthly_normalised": over(
        "clean", body=_normalised(MONTHLY_BODY, ["avg_fare", "avg_distance", "avg_tip", "avg_duration"])
    ),
    "rush_from_hourly": over(
        "hourly",
        body="""
        SELECT time_of_day, CAST(sum(total_trips) AS BIGINT) AS trips,
          round(avg(avg_fare), 6) AS mean_of_avg_fare, round(avg(avg_tip_pct), 6) AS mean_of_avg_tip_pct
        FROM hourly GROUP BY time_of_day
        """,
    ),
    "dow_from_daily": over(
        "calendar",
        body="""
        SELECT dow_num, left(any_value(dow_name), 3) AS day, CAST(sum(total_trips) AS BIGINT) AS trips,
          round(avg(avg_fare), 6) AS mean_of_avg_fare, round(avg(avg_tip_pct), 6) AS mean_of_avg_tip_pct,
          round(avg(avg_distance), 6) AS mean_of_avg_distance,
          round(avg(avg_distance) / 15 * 60, 6) AS est_duration_min
        FROM calendar GROUP BY dow_num
        """,
    ),
    "zone_pickup12": over("routes", body=_zones("PULocationID")),
    "zone_dropoff12": over("routes", body=_zones("DOLocationID")),
    "route_flow": over(
        "routes",
        body="""
        , top20 AS (SELECT * FROM routes ORDER BY trips DESC, PULocationID, DOLocationID LIMIT 20),
        nodes AS (SELECT PULocationID AS zone FROM top20 UNION SELECT DOLocationID FROM top20)
        SELECT (SELECT count(*) FROM nodes WHERE zone < PULocationID) AS source,
          (SELECT count(*) FROM nodes WHERE zone < DOLocationID) AS target,
          trips AS value, PULocationID AS origin, DOLocationID AS destination
        FROM top20
        """,
    ),
    "insights": over(
        "clean",
        "daily",
        body="""
        , days AS (SELECT dayname(trip_date) AS day, sum(total_trips) AS n, min(extract(dow FROM trip_date)) AS dow
                   FROM daily GROUP BY 1)
        SELECT count(*) AS total_trips, round(avg(fare_amount), 2) AS avg_fare,
          round(CAST(count(*) FILTER (WHERE time_of_day = 'evening_rush') AS DOUBLE)
            / nullif(count(*) FILTER (WHERE time_of_day = 'morning_rush'), 0), 1) AS rush_ratio,
          round(100.0 * count(*) FILTER (WHERE payment_type = 1)
            / nullif(count(*) FILTER (WHERE payment_type IN (1, 2)), 0), 1) AS card_share_pct,
          (SELECT day FROM days ORDER BY n DESC, dow LIMIT 1) AS busiest_day,
          (SELECT day FROM days ORDER BY n, dow LIMIT 1) AS quietest_day
        FROM clean
        """,
    ),
    "orders_daily": over("orders_daily", body="SELECT * FROM orders_daily"),
    "orders_rolling": over(
        "orders_daily",
        body=f"""
        SELECT order_date, total_orders, {_rolling("total_orders", "order_date", 14, 13)} FROM orders_daily
        """,
    ),
    "orders_status_rolling": f"""
    SELECT o_orderstatus, order_date, total_orders,
      {_rolling("total_orders", "order_date", 3, 3, "PARTITION BY o_orderstatus")}
    FROM (
      SELECT o_orderstatus, date_trunc('day', o_orderdate)::TIMESTAMP AS order_date, count(*) AS total_orders
      FROM orders GROUP BY ALL
    )
    """.strip(),
}
