"""Incremental pick-up of new trip files."""

from __future__ import annotations

from collections.abc import Callable

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.sources.marts import stored_partitions
from ridemart.sources.trips import read_as

# The columns of Spark's file source, of which only the path is read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_glob: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Load the files not loaded before and return the whole target table.

    What streams is the names of new files; each batch of files is then read with its own
    column types and cast, so a file whose types have drifted does not stop the stream. The
    checkpoint remembers loaded files, and a batch that is repeated after a failure replaces
    what it had written, so no file is skipped or loaded twice. ``transform`` has to be
    row-wise. A source without files gives an empty table. ``checkpoint`` and ``target`` belong on storage all executors share.
    """

    def load(batch: DataFrame, number: int) -> None:
        files = [unquote(r["path"]) for r in batch.collect()]  # files_per_batch names at most
        if files:
            transform(read_as(spark, schema, *files)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    arriving = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
    )
    query = (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    nothing = transform(spark.createDataFrame([], schema))
    shape = nothing.schema
    if not stored_partitions(spark, target, 1):  # no file has ever arrived
        return nothing
    return spark.read.schema(shape).parquet(target).select(*[F.col(f"`{c}`") for c in shape.names])
