"""SimHash near-duplicates found through a table of distances to reference fingerprints.

A text's fingerprint has bit b set when over half of its shingles' XXH64 values have it. Each
distinct fingerprint gets a table row: its Hamming distances to the origin, to 32 masks of two
adjacent bits and to 31 spread-out references. By the triangle inequality two fingerprints
within ``MAX_BITS`` bits differ by at most ``MAX_BITS`` in every coordinate.

Candidates come from equal coordinates, not from comparing all pairs: distance to the origin
and to a mask give the number of set bits in the mask's pair, and two differing bits touch at
most two of the 32 pairs. So of six groups of pairs at least four agree, and each fingerprint
enters one cell for each choice of four groups (15 cells of 32 bits of information). Pairs that
meet in a cell are discarded if any coordinate differs by more than ``MAX_BITS``; survivors are
verified on the fingerprints.

A cell of over ``CELL`` fingerprints (a large group of near copies) is not paired off. Its
members instead meet at the values one bit away from them: two fingerprints within two bits
share such a value, all that share one are within two bits of each other, and at most 65 can
share one. That finds every link of a large cell in steps that grow with its members.

Links are joined into components by alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ridemart.llm.common import stored

if TYPE_CHECKING:
    import numpy as np

#: Fingerprints link when at most this many bits differ. The cells below are made for two.
MAX_BITS = 2
#: Words of a shingle.
SHINGLE = 3
SEED = 42
#: Cells of more fingerprints go through one-bit neighbours.
CELL = 64
#: Shingles counted at once, which bounds the memory a very long text needs.
CHUNK = 65_536

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint_of(text: bytes | None, words: int = SHINGLE) -> int:
    """Fingerprint (unsigned) of a UTF-8 text; zero for a text without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    found = (text or b"").translate(_LOWER).split()  # bytes split at the six ASCII space characters
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in found), np.int64, len(found))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    spans = lambda at: zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
    return majority(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans(at)], np.uint64) for at in range(0, len(starts), CHUNK))


def majority(chunks: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the 64-bit hashes; zero without hashes."""
    import numpy as np

    counts, hashes = np.zeros(64, np.int64), 0
    for chunk in chunks:
        counts += np.unpackbits(chunk.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        hashes += len(chunk)
    return int.from_bytes(np.packbits(counts * 2 > hashes).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``fingerprint`` (long, the 64 bits) to every row; a null text has no words."""
    @F.arrow_udf(LongType())
    def hashed(texts: pa.Array) -> pa.Array:
        values = (fingerprint_of(t.as_py()) for t in texts)
        return pa.array((v - 2**64 if v >= 2**63 else v for v in values), pa.int64())

    return docs.withColumn("fingerprint", hashed(F.col(text).cast("binary")))


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _spread(k: int) -> int:
    """The k-th spread-out reference: a multiplicative hash of k."""
    x = (k + 1) * 0x9E3779B97F4A7C15 % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


PAIRS = 32
REFERENCES = [0, *(3 << 2 * j for j in range(PAIRS)), *(_spread(k) for k in range(31))]
#: The pairs of bits in six groups.
GROUPS = [range(g, PAIRS, 6) for g in range(6)]


def distances(fingerprint: str | Column) -> Column:
    """The table row of a fingerprint: its distance to each reference."""
    column = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    return F.array(*[F.bit_count(column.bitwiseXOR(F.lit(_signed(r)))).cast("tinyint") for r in REFERENCES])


def pivot_table(fingerprints: DataFrame) -> DataFrame:
    """Adds ``row``, the distances, and ``groups``, each group's pair counts as one number in base 3."""
    indices = F.array(*[F.array(*[F.lit(1 + j) for j in group]) for group in GROUPS])
    rows = fingerprints.withColumn("row", distances("fingerprint"))
    origin = F.col("row")[0].cast("long")
    counts = F.transform(
        indices,
        lambda group: F.aggregate(
            group, F.lit(0).cast("long"), lambda n, j: n * 3 + F.shiftright(origin + 2 - F.get(F.col("row"), j), 1)
        ),
    )
    return rows.withColumn("groups", counts)


def _cells() -> Column:
    """The cells of a table row, each packed into a long: four groups in base 729, and their choice."""
    chosen = F.array(*[F.array(*[F.lit(g) for g in choice]) for choice in combinations(range(len(GROUPS)), 4)])
    packed = lambda choice: F.aggregate(
        choice, F.lit(0).cast("long"), lambda n, g: n * 729 + F.get(F.col("groups"), g)
    )
    return F.transform(chosen, lambda choice, k: packed(choice) * 16 + k)


def furthest(row_a: str | Column, row_b: str | Column) -> Column:
    """The largest difference of two table rows in a coordinate; never above the Hamming distance."""
    return F.array_max(F.zip_with(row_a, row_b, lambda x, y: F.abs(x - y)))


def links(table: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``MAX_BITS`` bits.

    ``table`` is the pivot table of distinct fingerprints. Pairs of ordinary cells are all
    there; members of larger cells are linked through a common member.
    """
    entries = table.select("fingerprint", F.explode(_cells()).alias("cell"))
    shared = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(entries.join(shared, "cell"), "simhash_cells")

    small = members.filter(F.col("members") <= cell).withColumn("row", distances("fingerprint"))
    left = small.select("cell", F.col("fingerprint").alias("a"), F.col("row").alias("row_a"))
    right = small.select("cell", F.col("fingerprint").alias("b"), F.col("row").alias("row_b"))
    verified = (
        left.join(right, "cell")
        .filter(F.col("a") < F.col("b"))
        .filter(furthest("row_a", "row_b") <= MAX_BITS)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        .select("a", "b")
    )

    large = members.filter(F.col("members") > cell).select("fingerprint").distinct()
    near = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(64)])
    meeting = large.select(
        F.col("fingerprint").alias("b"), F.explode(F.transform(near, lambda m: F.col("fingerprint").bitwiseXOR(m))).alias("value")
    )
    starred = (
        meeting.withColumn("a", F.min("b").over(W.partitionBy("value")))  # at most 65 rows a value
        .filter(F.col("a") < F.col("b"))
        .select("a", "b")
    )
    return verified.union(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Each node of the edges (a, b) with the smallest node it is connected to: (node, component).

    Alternates large-star (a node's greater neighbours link to its smallest neighbour) and
    small-star (its smaller neighbours do) until nothing changes. Minima are combined before
    they are shuffled, no neighbourhood is collected, and each round's edges are stored.
    """

    def turned(df: DataFrame) -> DataFrame:
        return df.select(F.col("a").alias("b"), F.col("b").alias("a"))

    state = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "star")
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return state.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                state.select("a", "a").distinct()
            )
        seen = mark
        both = state.union(turned(state).select("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b").filter("a < b").distinct()
        )
        # Every edge runs from a greater node b to a smaller a.
        smallest = large.groupBy("b").agg(F.min("a").alias("least"))
        moved = large.join(smallest, "b")
        small = (
            moved.filter("a > least")
            .select(F.col("least").alias("a"), F.col("a").alias("b"))
            .union(smallest.select(F.col("least").alias("a"), "b"))
            .distinct()
        )
        state = stored(small, "star")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", cell: int = CELL) -> DataFrame:
    """One row (key, fingerprint, component_id) for each document.

    ``component_id`` is the smallest key among the documents reachable by links, the document
    itself included (null only if all their keys are null). Null, empty and blank texts have
    fingerprint zero and link like any other. Equal rows stay separate rows; an empty table
    gives an empty table. Other columns are not read.
    """
    marked = stored(with_fingerprint(docs.select(F.col(key), F.col(text)), text).select(key, "fingerprint"), "fingerprints")
    distinct = stored(
        pivot_table(marked.groupBy("fingerprint").agg(F.min(key).alias("first_key"))), "pivot_table"
    )
    reached = components(links(distinct, cell))
    linked = distinct.join(reached, distinct["fingerprint"] == reached["node"])
    smallest = linked.groupBy("component").agg(F.min("first_key").alias("component_id"))
    by_fingerprint = stored(
        distinct.join(
            linked.join(smallest, "component").select(F.col("node").alias("fingerprint"), "component_id"),
            "fingerprint",
            "left",
        ).select("fingerprint", F.coalesce("component_id", "first_key").alias("component_id")),
        "fingerprint_components",
    )
    return marked.join(by_fingerprint, "fingerprint")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op3: every document with its fingerprint and component."""
    found = near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", text.alias("fingerprint"), "component_id")
