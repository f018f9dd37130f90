"""Exact top-k of groups that are too many to group: sketched candidates and a proof.

A frequent-items sketch of bounded size names candidates. A second scan counts these exactly and
adds up all other rows by hash bucket; a key outside cannot have more rows than its bucket. Where
a bucket could hold a key of the top k, and only there, keys are grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.session import shared_folder
from ridemart.sources.marts import write_parquet

#: Hash buckets of the keys outside; also the largest number of rows that is broadcast.
BUCKETS = 65_536
#: Items the sketch tracks, and candidates taken of it for each wanted group.
TRACKED, SPARE = 8_192, 4


def _hashed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    return hashed.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))


def candidate_hashes(df: DataFrame, keys: Sequence[str], k: int, tracked: int = TRACKED) -> list[int]:
    """Hashes of keys that are probably frequent, at most ``SPARE * k``."""
    wanted = min(SPARE * k, tracked)
    row = df.select(F.xxhash64(*keys).alias("_hash")).agg(F.expr(f"approx_top_k(_hash, {wanted}, {tracked})").alias("top")).first()
    return [item["item"] for item in row["top"] or []]


def counted(df: DataFrame, keys: Sequence[str], hashes: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    """Rows by candidate key (``_bucket`` null) and, of all others, by bucket (keys null)."""
    rows = _hashed(df, keys, buckets).withColumn("_is", F.col("_hash").isin(list(hashes)))
    parts = [F.when(F.col("_is"), F.col(c)).alias(c) for c in keys]
    return rows.groupBy("_is", *parts, F.when(~F.col("_is"), F.col("_bucket")).alias("_bucket")).agg(F.count(F.lit(1)).alias("rows"))


def suspects(counts: DataFrame, k: int) -> DataFrame:
    """Buckets with as many rows as the k-th candidate, or all if there are fewer than k candidates."""
    least = counts.filter("_is").orderBy(F.desc("rows")).limit(k).agg(F.min("rows").alias("least"), F.count(F.lit(1)).alias("found"))
    least = least.select(F.when(F.col("found") < k, 0).otherwise(F.col("least")))
    return counts.filter(~F.col("_is") & (F.col("rows") >= least.scalar())).select("_bucket")


def top_groups(
    df: DataFrame, keys: Sequence[str], k: int, count: str = "trip_count", tracked: int = TRACKED, buckets: int = BUCKETS
) -> DataFrame:
    """The k groups with most rows: keys and ``count``; ties go to the smaller keys, nulls last.

    Always exact. Two scans where the largest groups stand out; a third one groups the keys of
    suspected buckets, which are all of them where no group does.
    """
    if k < 1:
        raise ValueError("k must be positive")
    hashes = candidate_hashes(df, keys, k, tracked)
    counts = write_parquet(counted(df, keys, hashes, buckets), shared_folder(df.sparkSession, "heavy_counts"))
    found = counts.filter("_is").select(*keys, "rows")
    named = suspects(counts, k)
    if not named.isEmpty():
        others = _hashed(df, keys, buckets).filter(~F.col("_hash").isin(hashes))
        others = others.join(F.broadcast(named), "_bucket", "left_semi")
        found = found.unionByName(others.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))
    order = [F.desc("rows"), *[F.asc_nulls_last(c) for c in keys]]
    return found.orderBy(*order).limit(k).withColumnRenamed("rows", count)
