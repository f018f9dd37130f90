"""Which rows of two tables differ, found by checksums of hash buckets.

Both tables are summed up by bucket first; only rows in buckets whose checksums disagree are
moved and compared one by one. Equal tables shuffle no more than their checksums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets a table is summed up by; also the largest number of rows that is broadcast.
BUCKETS = 4096

ONLY_LEFT, ONLY_RIGHT, CHANGED, REPEATED = "only left", "only right", "changed", "repeated"


def _row_hash(df: DataFrame) -> Column:
    # A null counts as a value of its own: xxhash64 alone skips it, so (1, null) and (null, 1) would agree.
    return F.xxhash64(*[x for c in df.columns for x in (F.isnull(c), F.col(c))])


def _marked(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"), _row_hash(df).alias("_hash"))


def checksums(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket of keys: bucket, rows, and the two halves of all row hashes added up.

    The sums do not depend on the order of rows and add up over disjoint parts of a table, so
    those of months can be stored and merged.
    """
    low, high = F.col("_hash").bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned("_hash", 32)
    return (
        _marked(df, keys, buckets)
        .groupBy(F.col("_bucket").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(high).alias("high"))
    )


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose checksums are not the same on both sides."""
    signed = [F.sum(F.col("_side") * F.col(c)).alias(c) for c in ("rows", "low", "high")]
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return both.groupBy("bucket").agg(*signed).filter("rows <> 0 OR low <> 0 OR high <> 0").select("bucket")


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per key whose rows differ: keys, left_rows, right_rows (that have no partner), change.

    Rows are compared by all columns, which must be the same on both sides, as often as they occur and in
    any order. ``change`` says whether the key's unmatched rows are on one side or both; a key
    that has matched rows too and more copies on one side is ``repeated``. Null keys are keys.
    """
    if left.columns != right.columns or [f.dataType for f in left.schema] != [f.dataType for f in right.schema]:
        raise ValueError("tables to compare must have the same columns and types")
    named = F.broadcast(  # at most ``buckets`` rows
        differing_buckets(checksums(left, keys, buckets), checksums(right, keys, buckets)).select(F.col("bucket").alias("_bucket"))
    )
    side = lambda df, sign: _marked(df, keys, buckets).join(named, "_bucket", "left_semi").withColumn("_side", F.lit(sign))
    of_row = (
        side(left, 1)
        .unionByName(side(right, -1))
        .groupBy(*keys, "_hash")
        .agg(F.sum("_side").alias("_surplus"), F.min("_side").alias("_least"), F.max("_side").alias("_most"))
    )
    found = of_row.groupBy(*keys).agg(
        F.sum(F.greatest("_surplus", F.lit(0))).cast("long").alias("left_rows"),
        F.sum(F.greatest(-F.col("_surplus"), F.lit(0))).cast("long").alias("right_rows"),
        F.bool_or(F.col("_least") < F.col("_most")).alias("_matched"),
    )
    change = (
        F.when(F.col("_matched") & ((F.col("left_rows") == 0) | (F.col("right_rows") == 0)), REPEATED)
        .when(F.col("right_rows") == 0, ONLY_LEFT)
        .when(F.col("left_rows") == 0, ONLY_RIGHT)
        .otherwise(CHANGED)
    )
    return found.filter("left_rows + right_rows > 0").select(*keys, "left_rows", "right_rows", change.alias("change"))


def differing_days(left: DataFrame, right: DataFrame, keys: Sequence[str], day: Column, buckets: int = BUCKETS) -> DataFrame:
    """Unmatched rows by day: trip_date, left_rows, right_rows. ``day`` is of both tables' columns."""
    dated = lambda df: df.withColumn("trip_date", day)
    rows = differing_keys(dated(left), dated(right), ["trip_date", *keys], buckets)
    return rows.groupBy("trip_date").agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
