"""What the operators share: words, stored intermediate tables, files of tasks, numbering."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.session import shared_folder

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: A to Z in lower case, all other characters as they are.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def n_words(text: str | Column) -> Column:
    """Words of a text; a missing text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: str | Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the folder all executors share, and read back.

    Cuts the lineage: what reads the result again neither repeats the work nor depends on an
    executor that may be lost.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go as soon as it ends, not when the driver next collects garbage.

    For jobs whose every result is stored: nothing reads their shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str,
    rows_in_group: str | None = None,
    block_rows: int = 50_000,
) -> DataFrame:
    """Adds each row's number within its group, from 0 without gaps, in order of a hash of ``order``.

    A group is cut into blocks of about ``block_rows`` rows by the high bits of the hash. Counts
    by block give each block's first number, and only a block is ever sorted in one task, so a
    group may hold any share of the rows. The numbers depend on values alone: rows that agree in
    all of ``order`` are adjacent and interchangeable. ``groups`` must not hold nulls.
    Columns of any name but ``name`` are kept. ``rows_in_group`` names a column that already has the size of the row's group.
    """
    groups = list(groups)
    hashed_as, block, first_as, size = unused(df, "_hash", "_block", "_first", "_in_group")
    added = [hashed_as, block, first_as]
    if rows_in_group is None:
        if groups:
            sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias(size))
            df = df.join(sizes, groups)
        else:
            df = df.withColumn(size, F.lit(df.count()))
        rows_in_group, added = size, [*added, size]
    hashed = df.withColumn(hashed_as, F.xxhash64(*order))
    # The upper 31 bits, shifted so that they grow with the signed hash.
    head = F.shiftrightunsigned(F.col(hashed_as).bitwiseXOR(F.lit(-(2**63)).cast("long")), 33)
    blocks = F.ceil(F.col(rows_in_group) / F.lit(block_rows))
    hashed = hashed.withColumn(block, F.shiftright(head * blocks, 31))
    before = W.partitionBy(*groups).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    first = (
        hashed.groupBy(*groups, block)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(*groups, block, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(first_as))
    )
    within = W.partitionBy(*groups, block).orderBy(hashed_as, *order)
    return (
        hashed.join(first, [*groups, block])
        .withColumn(name, F.col(first_as) + F.row_number().over(within) - 1)
        .drop(*added)
    )


def filesystem(uri: str):
    """pyarrow's file system for a folder that tasks write to, and the path within it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of any task uses.

    A task lists the files it has closed in its output rows; the stored list of those rows is
    what counts, so files of attempts that were lost or repeated are never read.
    """
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
