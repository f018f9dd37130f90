"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0 to n-1 by a hash of their values (distributed, see ``common.numbered``). A
Feistel network over pairs (left < a, right < b), with a*b the least such grid of n or more
cells, permutes the cells; a cell of n or more is permuted again until it falls below n (cycle
walking), which leaves a permutation of 0 to n-1. The permuted number p lies in shard p mod
shards at slot p div shards, so shards differ by one row at most, slots have no gaps, and both
directions can be computed from (n, shards, seed) alone.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.llm.common import numbered, stored, unused

ROUNDS = 6
#: A walk needs another step with a chance of about 1 in sqrt(n); this many never suffice only
#: if the seed is unlucky beyond belief, and then the job says so instead of giving wrong slots.
WALK = 64


def grid(n: int) -> tuple[int, int]:
    left = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return left, max(1, -(-n // left))


def _mixed_number(half: int, round_no: int, seed: int) -> int:
    return int(hashlib.md5(f"{seed}|{round_no}|{half}".encode()).hexdigest()[:12], 16)


def _pass(cell: Column, n: int, seed: int) -> Column:
    """One run of the network over a cell number; the halves stay in one struct."""
    a, b = grid(n)
    state = F.struct((cell % a).alias("left"), F.floor(cell / a).cast("long").alias("right"))

    def turn(halves: Column, i: Column) -> Column:
        left, right = halves["left"], halves["right"]
        text = lambda half: F.concat_ws("|", F.lit(str(seed)), i.cast("string"), half.cast("string"))
        mix = lambda half: F.conv(F.substring(F.md5(text(half)), 1, 12), 16, 10).cast("long")
        even = i % 2 == 0
        return F.struct(
            F.when(even, (left + mix(right)) % a).otherwise(left).alias("left"),
            F.when(even, right).otherwise((right + mix(left)) % b).alias("right"),
        )

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, state, turn, lambda s: s["right"] * a + s["left"])


def permuted(row: Column, n: int, seed: int) -> Column:
    """Column form of ``permuted_number``; the first pass is outside the walk, which few rows enter."""
    steps = F.sequence(F.lit(1), F.lit(WALK))
    first = _pass(row, n, seed)
    walk = F.aggregate(steps, first, lambda cell, _: F.when(cell < n, cell).otherwise(_pass(cell, n, seed)))
    lost = F.raise_error(F.lit(f"a walk took over {WALK} steps; choose another seed than {seed}")).cast("long")
    return F.when(walk < n, walk).otherwise(lost)


def permuted_number(row: int, n: int, seed: int) -> int:
    a, b = grid(n)
    cell = row
    while True:
        left, right = cell % a, cell // a
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + _mixed_number(right, i, seed)) % a
            else:
                right = (right + _mixed_number(left, i, seed)) % b
        cell = right * a + left
        if cell < n:
            return cell


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 42) -> int:
    """The row number kept at a shard's slot: the permutation run backwards."""
    a, b = grid(n)
    cell = slot * shards + shard
    while True:
        left, right = cell % a, cell // a
        for i in reversed(range(ROUNDS)):
            if i % 2 == 0:
                left = (left - _mixed_number(right, i, seed)) % a
            else:
                right = (right - _mixed_number(left, i, seed)) % b
        cell = right * a + left
        if cell < n:
            return cell


def place_of(row: int, n: int, shards: int, seed: int = 42) -> tuple[int, int]:
    """Shard and slot of a row number, without any table."""
    number = permuted_number(row, n, seed)
    return number % shards, number // shards


def shard(
    docs: DataFrame,
    keys: list[str],
    shards: int = 40,
    seed: int = 42,
    block_rows: int = 50_000,
) -> DataFrame:
    """Adds ``row_number``, ``shard`` and ``slot`` to every row.

    ``keys`` tell rows apart (any of them may be null). Rows that agree in all keys get adjacent
    row numbers in any order; an empty table gives an empty table. Columns of ``docs`` that bear
    one of the three names are replaced, columns of any other name kept.
    """
    kept = docs.drop("row_number", "shard", "slot")
    n = kept.count()
    size, place = unused(kept, "_n", "_p")
    rows = numbered(kept.withColumn(size, F.lit(n)), [], keys, "row_number", size, block_rows).drop(size)
    number = rows.withColumn(place, permuted(F.col("row_number"), n, seed))
    return number.withColumns(
        {
            "shard": (F.col(place) % shards).cast("int"),
            "slot": F.floor(F.col(place) / shards).cast("long"),
        }
    ).drop(place)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 16 for the row) and CRC-32 of each whole text; null counts as empty."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def query(spark, folder: str) -> DataFrame:
    """op8: all documents into 40 shards of equal row counts; the texts themselves are not shuffled."""
    rows = stored(measured(spark.read.parquet(f"{folder}/documents.parquet")), "op8_sizes")
    placed = shard(rows, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
