"""Packing into length buckets with the least padding.

Documents become pieces of at most ``max_tokens`` tokens. A histogram of piece lengths (at most
``max_tokens`` rows, whatever the corpus) goes to the driver, where dynamic programming finds the
bucket boundaries that minimise padding over all pieces: a piece is padded to the upper boundary
of its bucket. Inside a bucket, pieces are numbered in order of a hash and cut into batches of
as many pieces as the token budget holds at the bucket's padded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm.common import n_words, numbered, stored

MAX_TOKENS = 2_048
BUCKETS = 16
BATCH_TOKENS = 65_536


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    ``histogram`` maps length to number of pieces. With lengths l1 < l2 < ..., a bucket over
    li..lj costs the padding of its pieces to lj; best[k][j] is the least padding of l1..lj in k
    buckets. Of equal sums the one with the earlier cut is taken. O(buckets * lengths^2).
    """
    import numpy as np

    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    lengths = np.array(sorted(histogram), dtype=np.float64)
    if not len(lengths):
        return []
    rows = np.array([histogram[int(x)] for x in lengths], dtype=np.float64)
    pieces = np.concatenate(([0.0], np.cumsum(rows)))
    tokens = np.concatenate(([0.0], np.cumsum(rows * lengths)))
    n = len(lengths)
    # cost[i, j]: padding of lengths i..j (i <= j) in one bucket.
    cost = lengths[None, :] * (pieces[None, 1:] - pieces[:-1, None]) - (tokens[None, 1:] - tokens[:-1, None])
    cost[np.tril_indices(n, -1)] = np.inf
    best, cuts = cost[0], []
    for _ in range(min(buckets, n) - 1):
        # The last bucket starts at i >= 1; everything before it is packed already.
        total = best[:-1, None] + cost[1:, :]
        cut = total.argmin(0) + 1
        least = total.min(0)
        better = least < best
        cuts.append(np.where(better, cut, 0))
        best = np.where(better, least, best)
    bounds, j = [], n - 1
    for cut in reversed(cuts):
        if cut[j] > 0:  # else this bucket saves nothing
            bounds.append(int(lengths[j]))
            j = int(cut[j]) - 1
    bounds.append(int(lengths[j]))
    return sorted(bounds)


def pieces_of(docs: DataFrame, key: str, tokens: str, max_tokens: int) -> DataFrame:
    """key, piece, start and n_tokens of every piece; a document without tokens has one of 0."""
    count = F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0)).cast("long")
    last = F.greatest(F.ceil(count / max_tokens), F.lit(1)).cast("int") - 1
    cut = docs.select(F.col(key), count.alias("_count"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * max_tokens
    return cut.select(
        key, "piece", start.alias("start"), F.least(F.col("_count") - start, F.lit(max_tokens)).cast("int").alias("n_tokens")
    )


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    tokens: str = "n_tokens",
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row for each piece: key, piece, start, n_tokens, bucket, padded_to, batch, slot.

    ``docs`` has the key and the number of tokens; null and negative numbers count as 0. Pieces
    without tokens get null bucket, padded_to, batch and slot: no batch has room to waste on
    them, and no document is dropped. Batches are numbered within their bucket from 0, slots
    within their batch; only a bucket's last batch may be short. Rows that agree in key and
    piece are interchangeable; an empty table gives an empty table. ``order`` adds columns that
    tell rows with equal keys apart.
    """
    if not 0 < max_tokens <= batch_tokens:
        raise ValueError("a batch must hold a piece of max_tokens")
    carried = [key, *order]
    cut = pieces_of(docs, key, tokens, max_tokens) if not order else None
    if cut is None:
        cut = pieces_of(docs.withColumn("_key", F.struct(*carried)), "_key", tokens, max_tokens).select("_key.*", "piece", "start", "n_tokens")
    pieces = stored(cut, "pack_pieces")
    histogram = {r["n_tokens"]: r["rows"] for r in _histogram(pieces).collect()}  # at most max_tokens rows
    bounds = boundaries(histogram, buckets)
    if not bounds:
        empty = {c: F.lit(None).cast(t) for c, t in (("bucket", "int"), ("padded_to", "int"), ("batch", "long"), ("slot", "int"))}
        return pieces.withColumns(empty).select(key, "piece", "start", "n_tokens", *empty)
    upper = F.array(*[F.lit(b) for b in bounds])
    inside = [sum(n for length, n in histogram.items() if low < length <= b) for low, b in zip([0, *bounds], bounds)]
    bucketed = pieces.filter("n_tokens > 0").withColumn("bucket", F.size(F.filter(upper, lambda b: b < F.col("n_tokens"))))
    sized = bucketed.withColumn("_rows", F.get(F.array(*[F.lit(n).cast("long") for n in inside]), "bucket"))
    placed = numbered(sized, ["bucket"], [*carried, "piece", "n_tokens"], "_place", "_rows")
    padded = F.get(upper, "bucket")
    per_batch = F.floor(F.lit(batch_tokens) / padded)
    full = placed.select(
        key, "piece", "start", "n_tokens", "bucket",
        padded.alias("padded_to"),
        F.floor(F.col("_place") / per_batch).cast("long").alias("batch"),
        (F.col("_place") % per_batch).cast("int").alias("slot"),
    )
    none = pieces.filter("n_tokens = 0").select(
        key, "piece", "start", "n_tokens",
        F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("int").alias("padded_to"),
        F.lit(None).cast("long").alias("batch"), F.lit(None).cast("int").alias("slot"),
    )
    return full.union(none)


def _histogram(pieces: DataFrame) -> DataFrame:
    return pieces.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("rows"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op6: all documents packed, a word being a token."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pack(docs.select("doc_id", n_words("text").alias("n_tokens")))
