"""Table storage: Parquet tables, catalog tables and CSV exports of marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    only_these_partitions: bool = False,
) -> DataFrame:
    """Write a Parquet table and return it read back, with the schema it was written with.

    The write is a narrow job: tasks write what they scan, so input that already arrives
    in period order gives few files per partition value. For unordered input set
    ``rebalance``: one shuffle by the partition columns, whose partitions adaptive
    execution splits when they are too large (a hot month) and merges when too small.
    ``only_these_partitions`` replaces the partitions that occur in the rows and leaves the
    table's others as they are.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    mode = "dynamic" if only_these_partitions else "static"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with a given schema, which also fixes the types of partition columns."""
    names = [f.name.replace("`", "``") for f in schema.fields]
    return spark.read.schema(schema).parquet(path).select(*[f"`{name}`" for name in names])


def _folder(spark: SparkSession, path: str):
    """Hadoop's path and the file system it lies on, whichever store that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders of a stored table, such as ``year=2024/month=1``; none if it is not there.

    Lists folders only, as many as the table has partitions.
    """
    at, store = _folder(spark, path)
    found = [(at, "")] if store.exists(at) else []
    for _ in range(depth):
        found = [
            (s.getPath(), f"{name}/{s.getPath().getName()}".lstrip("/"))
            for folder, name in found
            for s in store.listStatus(folder)
            if s.isDirectory() and "=" in s.getPath().getName()
        ]
    return [name for _, name in found]


def drop_partitions(spark: SparkSession, path: str, partitions: Iterable[str]) -> None:
    """Deletes partition folders of a stored table; those that are not there are passed over."""
    for name in partitions:
        at, store = _folder(spark, f"{path}/{name}")
        store.delete(at, True)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a catalog table from a DataFrame."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Register a DataFrame as a view: nothing is stored, each use re-plans it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_or(spark: SparkSession, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
    """The catalog table when it exists, otherwise the derived DataFrame."""
    return spark.table(name) if spark.catalog.tableExists(name) else derive()


def csv_or(spark: SparkSession, path: str, schema: T.StructType, derive: Callable[[], DataFrame]) -> DataFrame:
    """The CSV export when the path exists, otherwise the derived DataFrame."""
    try:
        found = read_mart_csv(spark, path, schema)
        found.schema  # resolves the path
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return derive()
    return found


def export_mart(df: DataFrame, path: str) -> None:
    """Header CSV in one file. For marts only: one row per day, hour or zone.

    ``repartition`` moves the finished mart rows; ``coalesce`` would also pull the
    aggregation before it into the one writing task.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def read_mart_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd['T'][ ]HH:mm:ss[.SSS]")
        .csv(path)
    )


def list_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and row count of each given table.

    A count of a stored Parquet table reads file footers only.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views of the current database."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, kind string, is_temporary boolean")
