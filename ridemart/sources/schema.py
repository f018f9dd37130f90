"""Explicit schemas. Raw input is never inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _DOUBLE, _INT = T.LongType(), T.DoubleType(), T.IntegerType()
_TEXT, _TIME = T.StringType(), T.TimestampNTZType()

RAW_TRIPS = _struct(
    ("VendorID", _LONG),
    ("tpep_pickup_datetime", _TIME),
    ("tpep_dropoff_datetime", _TIME),
    ("passenger_count", _DOUBLE),
    ("trip_distance", _DOUBLE),
    ("RatecodeID", _DOUBLE),
    ("PULocationID", _LONG),
    ("DOLocationID", _LONG),
    ("payment_type", _LONG),
    ("fare_amount", _DOUBLE),
    ("extra", _DOUBLE),
    ("mta_tax", _DOUBLE),
    ("tip_amount", _DOUBLE),
    ("tolls_amount", _DOUBLE),
    ("total_amount", _DOUBLE),
    ("congestion_surcharge", _DOUBLE),
)

CLEAN_TRIPS = _struct(
    *[
        (f.name, f.dataType)
        for f in RAW_TRIPS.fields
        if f.name not in ("extra", "mta_tax")
    ],
    ("pickup_hour", _LONG),
    ("pickup_dow", _LONG),
    ("pickup_month", _LONG),
    ("trip_duration_min", _LONG),
    ("avg_speed_mph", _DOUBLE),
    ("tip_pct", _DOUBLE),
    ("time_of_day", _TEXT),
)

DAILY_SUMMARY = _struct(
    ("trip_date", _TIME),
    ("total_trips", _LONG),
    ("avg_fare", _DOUBLE),
    ("avg_distance", _DOUBLE),
    ("avg_duration_min", _DOUBLE),
    ("total_revenue", _DOUBLE),
    ("avg_tip_pct", _DOUBLE),
    ("morning_rush_trips", _LONG),
    ("evening_rush_trips", _LONG),
)

HOURLY_PATTERNS = _struct(
    ("pickup_hour", _LONG),
    ("time_of_day", _TEXT),
    ("total_trips", _LONG),
    ("avg_fare", _DOUBLE),
    ("avg_distance", _DOUBLE),
    ("avg_tip_pct", _DOUBLE),
    ("avg_speed_mph", _DOUBLE),
)


EVENTS = _struct(
    ("event_id", _LONG),
    ("ts", _TIME),
    ("user_id", _LONG),
    ("event_type", _TEXT),
    ("value", _DOUBLE),
    ("props", _TEXT),
)

ORDERS = _struct(
    ("o_orderkey", _LONG),
    ("o_custkey", _LONG),
    ("o_orderstatus", _TEXT),
    ("o_totalprice", _DOUBLE),
    ("o_orderdate", _TIME),
    ("o_orderpriority", _TEXT),
)

LINEITEM = _struct(
    ("l_orderkey", _LONG),
    ("l_partkey", _LONG),
    ("l_suppkey", _LONG),
    ("l_linenumber", _INT),
    ("l_quantity", _DOUBLE),
    ("l_extendedprice", _DOUBLE),
    ("l_discount", _DOUBLE),
    ("l_tax", _DOUBLE),
    ("l_returnflag", _TEXT),
    ("l_linestatus", _TEXT),
    ("l_shipdate", _TIME),
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail while planning, not in a task, when an input column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns {missing}; it has {df.columns}")
    return df


def columns_of(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
