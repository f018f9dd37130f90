"""Importance resampling of documents towards a target text, with feature counts by segment.

Features are runs of one to ``order`` words, hashed into buckets. How often each bucket occurs in
all documents is counted by segments: newlines cut texts into lines, equal lines are merged with
their number of occurrences before anything is hashed, each distinct line's features are counted
once and multiplied, and the runs of words that cross from one line into another are added
separately (there are none for single words). A bucket's gain is the logarithm of its smoothed
share in the target over that in the documents; a document's weight is the sum of its gains.
Gumbel noise by document turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ridemart.llm.common import ascii_lower, stored

#: Buckets that features are hashed into; as many counts at most are taken to the driver.
BUCKETS = 10_000
#: Words of the longest feature.
ORDER = 1
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Per cent of the other documents that are drawn.
SHARE = 10
SEED = "2024"
#: Words whose buckets a task remembers before it starts afresh.
REMEMBERED = 500_000

#: Bytes of a word as they are (digits, letters in lower case, all beyond ASCII), others as spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A to Z in lower case; none for a missing text."""
    return (text or b"").translate(_TABLE).split()


class Hasher:
    """Buckets of words and runs of words; those of single words are remembered."""

    def __init__(self, buckets: int = BUCKETS, order: int = ORDER):
        self.buckets, self.order, self.known = buckets, order, {}

    def words(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = crc32(word) % self.buckets
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def runs(self, words: list[bytes], length: int) -> np.ndarray:
        """Buckets of all runs of ``length`` consecutive words, in order."""
        if length == 1:
            return self.words(words)
        many = max(0, len(words) - length + 1)
        return np.fromiter((crc32(b" ".join(words[k : k + length])) % self.buckets for k in range(many)), np.int64, many)

    def features(self, words: list[bytes]) -> np.ndarray:
        return np.concatenate([self.runs(words, n) for n in range(1, self.order + 1)])

    def crossing(self, lines: list[list[bytes]]) -> np.ndarray:
        """Buckets of the runs that begin in one of a text's lines and end in a later one."""
        words = [w for line in lines for w in line]
        at = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
        found = [np.zeros(0, np.int64)]
        for n in range(2, self.order + 1):
            if len(words) >= n:
                found.append(self.runs(words, n)[at[: len(words) - n + 1] != at[n - 1 :]])
        return np.concatenate(found)


_COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])


def _counts_of(rows: DataFrame, added, buckets: int) -> DataFrame:
    """(bucket, n) of all rows: each task adds up its rows into one vector of ``buckets`` counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, add = np.zeros(buckets, np.int64), added()
        for batch in batches:
            add(total, batch)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], schema=_COUNTS)

    return rows.mapInArrow(counted, "bucket long, n long")


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): how often each bucket occurs among the features of all texts.

    Null and empty texts and lines without words have no features. Other columns are not read.
    """
    lines = (
        docs.select(F.explode(F.split(ascii_lower(text), "\n")).alias("line"))
        .filter("line <> ''")
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("times"))
        .select(F.col("line").cast("binary").alias("line"), "times")
    )

    def by_line():
        hasher = Hasher(buckets, order)

        def add(total, batch):
            found = [hasher.features(words_of(line.as_py())) for line in batch.column(0)]
            times = np.repeat(batch.column(1).to_numpy(), [len(f) for f in found])
            np.add.at(total, np.concatenate([np.zeros(0, np.int64), *found]), times)

        return add

    def by_crossing():
        hasher = Hasher(buckets, order)

        def add(total, batch):
            for t in batch.column(0):
                np.add.at(total, hasher.crossing([words_of(line) for line in (t.as_py() or b"").split(b"\n")]), 1)

        return add

    counts = _counts_of(lines, by_line, buckets)
    if order > 1:
        counts = counts.union(_counts_of(docs.select(F.col(text).cast("binary")), by_crossing, buckets))
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(counts: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths; takes at most two counts a bucket to the driver."""

    def vector(df: DataFrame) -> list[int]:
        values = [0] * buckets
        for bucket, n in df.collect():
            values[bucket] = n
        return values

    have, want = vector(counts), vector(target)
    S, T = sum(have), sum(want)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(have, want, strict=True)],
        np.int64,
    )


_WEIGHED = StructType([StructField(name, LongType()) for name in ("n_words", "n_features", "weight")])


def weighed(docs: DataFrame, gain: np.ndarray, text: str = "text", order: int = ORDER) -> DataFrame:
    """Adds ``weighed``: n_words, n_features and weight of every whole text."""

    @F.arrow_udf(_WEIGHED)
    def weigh(texts: pa.Array) -> pa.Array:
        hasher, rows = Hasher(len(gain), order), []
        for t in texts:
            words = words_of(t.as_py())
            found = hasher.features(words)
            rows.append((len(words), len(found), int(gain[found].sum())))
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in np.array(rows, np.int64).reshape(-1, 3).T], _WEIGHED.names)

    return docs.withColumn("weighed", weigh(F.col(text).cast("binary")))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row for each document: key, n_features, weight, score and rank.

    ``rank`` numbers the drawn documents from 1 by falling score, ties to the smaller key (missing
    keys last), then to a hash of the text; rows that agree in all three are interchangeable. All
    other documents have a null rank. A missing key enters the noise as an empty one. Null and
    empty texts have no words and the weight 0; an empty table gives an empty table, and with an
    empty target every bucket is equally wanted. Columns other than key and text are not read, so
    none can clash.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    gain = gains(
        bucket_counts(rows, "text", buckets, order),
        bucket_counts(target.select(F.col(target_text).alias("text")), "text", buckets, order),
        buckets,
    )
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    found = weighed(rows, gain, "text", order).select("key", F.xxhash64("text").alias("tie"), "weighed.*")
    scored = stored(found.withColumn("score", F.col("weight") + noise), "resampling_scores")

    wanted = scored.filter(F.col("n_words") >= least_words)
    drawn = wanted.count() * share // 100
    order_by = [F.desc("score"), F.asc_nulls_last("key"), F.asc("tie")]
    # Sorted by ranges and stored with its range, so that ranges' sizes give each one's first rank.
    ranged = stored(wanted.repartitionByRange(*order_by).withColumn("part", F.spark_partition_id()), "resampling_ranges")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    first = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    place = F.col("first") + F.row_number().over(W.partitionBy("part").orderBy(*order_by))
    ranked = ranged.join(first, "part").withColumn("rank", F.when(place <= drawn, place))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).union(rest.select(*columns))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op13: all documents, weighed towards the benchmark texts."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return resampled(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


ORACLE = """
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS entries
  FROM range(256) AS r(b)
),
texts AS (
  SELECT 'd' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
),
words AS (
  SELECT kind, doc_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM texts
),
per_word AS (SELECT kind, word, count(*) AS n FROM words GROUP BY ALL),
bytes AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2] AS BIGINT)) AS b
  FROM (SELECT DISTINCT word FROM per_word)
),
hashed AS (
  SELECT word, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, entries[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table
),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 't'), 0) AS t
  FROM per_word JOIN hashed USING (word) GROUP BY bucket
),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM counts, totals
),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight
  FROM words JOIN hashed USING (word) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY doc_id
),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM ranked) THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
