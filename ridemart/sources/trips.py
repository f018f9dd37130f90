"""Trip readers: multi-file Parquet, and the trip-shaped view over the events table."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.operators.columns import TripColumns
from ridemart.functions.temporal import day_distance
from ridemart.sources.schema import RAW_TRIPS, columns_of, require_columns

SOURCE_FILE = "source_file"



def _same_types(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The files in runs whose columns have the same types; only footers are read.

    Footers are merged in a Spark job. Files that cannot be merged are halved and tried again,
    so a change of types in a long list is found in a few jobs.
    """
    try:
        spark.read.option("mergeSchema", True).parquet(*files).schema
    except Exception as differing:
        if len(files) == 1 or "CANNOT_MERGE" not in str(differing):
            raise
        half = len(files) // 2
        return [*_same_types(spark, files[:half]), *_same_types(spark, files[half:])]
    return [files]


def read_trips(spark: SparkSession, *paths: str, with_file: bool = False) -> DataFrame:
    """Raw trips from Parquet folders, globs or files, with the fixed raw schema."""
    return read_as(spark, RAW_TRIPS, *paths, with_file=with_file)


def read_as(spark: SparkSession, schema: T.StructType, *paths: str, with_file: bool = False) -> DataFrame:
    """The columns of a schema from Parquet folders, globs or files.

    Files may differ in column types (monthly files drift between whole numbers and doubles,
    and between widths) and in the case of column names: those of one kind are read together
    with their own types and cast, where types differ. Other columns are not read. A file
    without one of the columns is an error. ``with_file`` adds the path of each row's file.
    """
    first = spark.read.parquet(*paths)
    groups = _same_types(spark, [unquote(f) for f in first.inputFiles()] or list(paths))
    if len(groups) == 1:
        return _fixed(first, schema, with_file)
    kinds: dict[tuple, list[str]] = {}
    for files in groups:
        fields = spark.read.parquet(*files).schema.fields
        kinds.setdefault(tuple(sorted((f.name.lower(), f.dataType.simpleString()) for f in fields)), []).extend(files)
    return reduce(DataFrame.unionByName, [_fixed(spark.read.parquet(*files), schema, with_file) for files in kinds.values()])


def _fixed(df: DataFrame, schema: T.StructType, with_file: bool) -> DataFrame:
    names = {c.lower(): c for c in df.columns}
    require_columns(df.toDF(*[c.lower() for c in df.columns]), [c.lower() for c in columns_of(schema)])
    fixed = [F.col(names[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields]
    if with_file:
        fixed.append(F.col("_metadata.file_path").alias(SOURCE_FILE))
    return df.select(*fixed)


def volume(df: DataFrame, file_column: str = SOURCE_FILE, at: TripColumns = TripColumns()) -> DataFrame:
    """One row: rows, distinct files, first and last pickup, whole days between them.

    Rows are first counted per file, so the distinct count shuffles one row per file and
    task instead of expanding the input.
    """
    per_file = df.groupBy(file_column).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(at.pickup).alias("first"),
        F.max(at.pickup).alias("last"),
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(file_column).alias("file_count"),
        F.min("first").alias("earliest_trip"),
        F.max("last").alias("latest_trip"),
    ).withColumn("date_span_days", day_distance("earliest_trip", "latest_trip"))


def describe_schema(df: DataFrame, count_nulls: bool = False) -> DataFrame:
    """Column name, type and nullability of any DataFrame, as rows in column order; runs no job.

    Parquet declares every column nullable. With ``count_nulls`` nulls are counted for all
    columns in one scan, and ``nullable`` says whether the data has any.
    """
    fields = list(enumerate(df.schema.fields))
    if not count_nulls:
        rows = [(i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO") for i, f in fields]
        shape = "position int, column_name string, column_type string, nullable string"
        return df.sparkSession.createDataFrame(rows, shape)
    counted = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}") for i, f in fields])
    arms = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.when(F.col(f"n{i}") > 0, "YES").otherwise("NO").alias("nullable"),
                F.col(f"n{i}").alias("null_count"),
            )
            for i, f in fields
        ]
    )
    return counted.select(F.inline(arms))


def trips_from_events(events: DataFrame) -> DataFrame:
    """Shape the events table like raw trips, bad values included; ``trip_id`` is the key.

    A narrow projection: no shuffle, works on a batch or a streaming DataFrame. A column
    ``source_file`` of the input is carried along.
    """
    carried = [c for c in events.columns if c == SOURCE_FILE]
    shaped = events.selectExpr(
        "event_id AS trip_id",
        "user_id",
        "IF(event_id % 211 = 0, ts - INTERVAL '8000' DAY, ts + INTERVAL '1' DAY * (event_id % 3 * 30))"
        " AS tpep_pickup_datetime",
        "CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 14400"
        " ELSE 20 + event_id * 37 % 5400 END AS ride_s",
        "IF(event_id % 41 = 0, NULL, DOUBLE((user_id + event_id) % 8)) AS passenger_count",
        "IF(event_id % 307 = 0, 250D, DOUBLE(event_id * 53 % 2500) / 100) AS trip_distance",
        "3 + DOUBLE(event_id * 53 % 2500) / 40 + value / 10 AS base_fare",
        *carried,
    ).selectExpr(
        "*",
        "CASE WHEN trip_id % 113 = 0 THEN -base_fare WHEN trip_id % 127 = 0 THEN base_fare + 500"
        " ELSE base_fare END AS fare_amount",
        "tpep_pickup_datetime + INTERVAL '1' SECOND * ride_s AS tpep_dropoff_datetime",
    )
    # A generated row fixes the costly values once. Without it the optimizer rewrites every
    # filter above in terms of the formulas, repeating them dozens of times per row. It holds
    # few fields, so that the code made for a scan stays small enough for the JVM to compile.
    fixed = [
        "trip_id", "user_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "fare_amount", *carried,
    ]
    return (
        shaped.select(F.inline(F.array(F.struct(*fixed))))
        .selectExpr(
            "*",
            "DOUBLE(trip_id % 3) / 2 AS extra",
            "0.5D AS mta_tax",
            "IF(trip_id % 151 = 0, -1D, DOUBLE(trip_id * 7 % 900) / 100) AS tip_amount",
            "IF(trip_id % 13 = 0, 6.55D, 0D) AS tolls_amount",
        )
        .selectExpr(
            "trip_id",
            "1 + trip_id % 2 AS VendorID",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "passenger_count",
            "trip_distance",
            "CASE WHEN trip_id % 41 = 0 THEN NULL WHEN trip_id % 50 = 0 THEN 99D"
            " ELSE DOUBLE(1 + trip_id % 7) END AS RatecodeID",
            "1 + user_id * 7 % 24 AS PULocationID",
            "1 + trip_id * 11 % 17 AS DOLocationID",
            "CASE WHEN trip_id % 199 = 0 THEN 0L WHEN trip_id % 10 < 6 THEN 1L WHEN trip_id % 10 < 8 THEN 2L"
            " ELSE 3 + trip_id % 4 END AS payment_type",
            "fare_amount",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "fare_amount + extra + mta_tax + tip_amount + tolls_amount AS total_amount",
            "IF(trip_id % 41 = 0, NULL, 2.5D) AS congestion_surcharge",
            *carried,
        )
    )
