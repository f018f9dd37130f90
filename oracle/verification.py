"""Mart verification."""

from oracle.base import over

_HEAD = (
    "trip_date, total_trips, avg_fare, total_revenue, avg_tip_pct, morning_rush_trips, evening_rush_trips"
)


def _assertion(mart: str, table: str, facts: dict[str, str]) -> str:
    pairs = ", ".join(f"{{'assertion': '{table}: {name}', 'ok': {fact}}}" for name, fact in facts.items())
    return f"SELECT unnest([{pairs}], recursive := true) FROM {mart}"


_DAILY_FACTS = {
    "trip_date is unique": "count(*) = count(DISTINCT trip_date)",
    "no null trip_date": "count(*) = count(trip_date)",
    "no null total_trips": "count(*) = count(total_trips)",
    "total_trips > 0": "min(total_trips) > 0",
    "avg_fare in plausible range (0, 200)": "min(avg_fare) > 0 AND max(avg_fare) < 200",
}
_HOURLY_FACTS = {
    "pickup_hour is unique": "count(*) = count(DISTINCT pickup_hour)",
    "no null pickup_hour": "count(*) = count(pickup_hour)",
    "covers all 24 hours": "count(*) = 24",
    "total_trips > 0 for all hours": "min(total_trips) > 0",
    "avg_fare in plausible range (0, 200)": "min(avg_fare) > 0 AND max(avg_fare) < 200",
    "avg_speed_mph in plausible range (0, 100)": "min(avg_speed_mph) > 0 AND max(avg_speed_mph) < 100",
}


def _extreme(name: str, column: str, direction: str, text: str) -> str:
    return (
        f"(SELECT '{name}' AS metric, trip_date::VARCHAR AS date, {text} AS value FROM daily "
        f"ORDER BY {column} {direction}, trip_date LIMIT 1)"
    )


def _outliers(table: str, value: str, columns: str) -> str:
    return f"""
    SELECT {columns}, round(({value} - m) / s, 2) AS z_score
    FROM (SELECT *, avg({value}) OVER () AS m, stddev_samp({value}) OVER () AS s FROM {table})
    WHERE {value} > m + 2 * s OR {value} < m - 2 * s
    """


def _gaps(table: str, day: str) -> str:
    return f"""
    SELECT prev::VARCHAR || ' → ' || cur::VARCHAR AS gap_range, date_diff('day', prev, cur) - 1 AS missing_days
    FROM (SELECT {day} AS cur, lag({day}) OVER (ORDER BY {day}) AS prev FROM {table})
    WHERE date_diff('day', prev, cur) >= 2
    """


# Which trips the compared copy has lost, charges more, or has twice.
_FAULTY = """
  SELECT trip_id, tpep_pickup_datetime AS picked_up,
    CASE WHEN pickup_hour = 3 AND passenger_count = 6 AND payment_type = 2 THEN 'only left'
         WHEN pickup_hour = 5 AND pickup_dow = 2 THEN 'changed'
         WHEN pickup_hour = 11 AND payment_type = 4 THEN 'repeated' END AS change
  FROM clean
"""

STATEMENTS = {
    "differing_trips": over(
        "clean",
        body=f"""
        SELECT trip_id, CAST(change <> 'repeated' AS BIGINT) AS left_rows,
          CAST(change <> 'only left' AS BIGINT) AS right_rows, change
        FROM ({_FAULTY}) WHERE change IS NOT NULL
        """,
    ),
    "differing_days": over(
        "clean",
        body=f"""
        SELECT date_trunc('day', picked_up)::TIMESTAMP AS trip_date,
          count(*) FILTER (WHERE change <> 'repeated') AS left_rows,
          count(*) FILTER (WHERE change <> 'only left') AS right_rows
        FROM ({_FAULTY}) WHERE change IS NOT NULL GROUP BY 1
        """,
    ),
    "mart_row_counts": over(
        "stg",
        "daily",
        "hourly",
        body="""
        SELECT 'stg_trips' AS table_name, count(*) AS row_count FROM stg
        UNION ALL SELECT 'mart_daily_summary', count(*) FROM daily
        UNION ALL SELECT 'mart_hourly_patterns', count(*) FROM hourly
        """,
    ),
    "first_days": over("daily", body=f"SELECT {_HEAD} FROM daily ORDER BY trip_date LIMIT 14"),
    "last_days": over("daily", body=f"SELECT {_HEAD} FROM daily ORDER BY trip_date DESC LIMIT 14"),
    "hourly_listing": over(
        "hourly", body="SELECT pickup_hour, time_of_day, total_trips, avg_fare, avg_speed_mph FROM hourly"
    ),
    "mart_assertions": over(
        "daily",
        "hourly",
        body=f"""
        SELECT assertion, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({_assertion("daily", "daily", _DAILY_FACTS)}
              UNION ALL {_assertion("hourly", "hourly", _HOURLY_FACTS)})
        """,
    ),
    "reconcile": over(
        "stg",
        "daily",
        body="""
        SELECT *, if(staging_trips = daily_trips, 'PASS', 'FAIL') AS trips_match,
          if(abs(staging_revenue - daily_revenue) < 1000, 'PASS', 'FAIL') AS revenue_match
        FROM (
          SELECT (SELECT count(*) FROM stg) AS staging_trips,
            (SELECT CAST(sum(total_trips) AS BIGINT) FROM daily) AS daily_trips,
            round((SELECT sum(total_amount) FROM stg), 2) AS staging_revenue,
            round((SELECT sum(total_revenue) FROM daily), 2) AS daily_revenue
        )
        """,
    ),
    "best_worst": over(
        "daily",
        body=" UNION ALL ".join(
            [
                _extreme("Highest Trips", "total_trips", "DESC", "total_trips::VARCHAR"),
                _extreme("Lowest Trips", "total_trips", "ASC", "total_trips::VARCHAR"),
                _extreme("Highest Revenue", "total_revenue", "DESC", "'$' || total_revenue::VARCHAR"),
                _extreme("Highest Avg Fare", "avg_fare", "DESC", "'$' || avg_fare::VARCHAR"),
                _extreme("Lowest Avg Fare", "avg_fare", "ASC", "'$' || avg_fare::VARCHAR"),
            ]
        ),
    ),
    "daily_stats": over(
        "daily",
        body="""
        SELECT round(avg(total_trips)) AS avg_daily_trips, round(stddev_samp(total_trips)) AS std_daily_trips,
          min(total_trips) AS min_daily_trips, max(total_trips) AS max_daily_trips,
          round(avg(total_revenue)) AS avg_daily_revenue, round(stddev_samp(total_revenue)) AS std_daily_revenue
        FROM daily
        """,
    ),
    "outlier_days": over(
        "daily", body=_outliers("daily", "total_trips", "trip_date, total_trips, avg_fare, total_revenue")
    ),
    # The fixture has every day of the period; one is left out so that there is a gap to find.
    "date_gaps": over("daily", body=_gaps("(SELECT * FROM daily WHERE trip_date <> DATE '2024-01-17')", "trip_date")),
    "orders_outlier_days": over(
        "orders_daily", body=_outliers("orders_daily", "total_orders", "order_date, total_orders, revenue")
    ),
    "orders_date_gaps": over("orders_daily", body=_gaps("orders_daily", "order_date")),
}
