"""Reproducible samples of an exact size, and a reproducible train/test split.

A row's place in the sample comes from a hash of its key, never from partitioning or task
order, so the same rows are chosen on any cluster and after any retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hash_text(keys: Sequence[str], seed: int, role: str = "") -> Column:
    """Hex digest of seed and key columns; a missing key part hashes as an empty part.

    ``role`` goes into the hashed text, so digests for different roles are independent.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *[F.lit(x) for x in (role, str(seed)) if x], *parts))


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """The min(n, rows) rows with the smallest key hash, in no order.

    ``orderBy(hash).limit(n)`` would let every task hand n rows to the last one. Instead the
    n-th digest is found and rows are filtered by it; only rows with that digest are moved. A
    first pass counts rows by the head of their digest, its leading zeros and the digit after
    them (a few hundred heads at most, whatever the input); a second orders the digests, not
    the rows, of the one head that holds the n-th. Rows that share that digest are taken in
    order of their keys until there are n.
    """
    hashed = df.withColumn("_digest", hash_text(keys, seed))
    head = F.expr("substring(_digest, 1, length(_digest) - length(trim(LEADING '0' FROM _digest)) + 1)")

    def nth(counted: DataFrame, name: str, before: Column) -> Column:
        """The first value at which the running count reaches n, and the count before it."""
        so_far = W.orderBy(name).rowsBetween(W.unboundedPreceding, W.currentRow)
        upto = counted.withColumn("upto", before + F.sum("rows").over(so_far))
        reached = upto.filter(F.col("upto") >= n)
        return reached.agg(F.min(F.struct(F.col(name).alias("value"), (F.col("upto") - F.col("rows")).alias("before")))).scalar()

    heads = hashed.groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("rows"))
    last_head = nth(heads, "head", F.lit(0))
    digests = hashed.filter(head == last_head["value"]).groupBy("_digest").agg(F.count(F.lit(1)).alias("rows"))
    cut = nth(digests, "_digest", last_head["before"])
    # Without a cut there are fewer than n rows, and all are taken. Only rows that share the cut's
    # digest are numbered, by their keys; all others stay where they are.
    below = hashed.filter(F.coalesce(F.col("_digest") < cut["value"], F.lit(True)))
    place = F.row_number().over(W.partitionBy("_digest").orderBy(*keys))
    tied = hashed.filter(F.col("_digest") == cut["value"]).withColumn("_tied", place)
    tied = tied.filter(F.col("_tied") <= F.lit(n) - cut["before"]).drop("_tied")
    return below.union(tied).drop("_digest")


def in_test(keys: Sequence[str], test_share: float = 0.2, seed: int = 42) -> Column:
    """True for the rows of the test part, whatever sample was drawn with the same seed before.

    The first 32 bits of a digest of its own, as a number, are compared with the share.
    """
    if not 0 <= test_share <= 1:
        raise ValueError("test_share must lie between 0 and 1")
    place = F.conv(F.substring(hash_text(keys, seed, "split"), 1, 8), 16, 10).cast("long")
    return place < F.lit(round(test_share * 2**32))


def split(
    df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete and independent of partitioning."""
    test = in_test(keys, test_share, seed)
    return df.filter(~test), df.filter(test)
