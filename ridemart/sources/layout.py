"""Tables laid out along a space-filling curve, so that filters on any of its columns skip data.

Sorting by one column leaves the others spread over every row group. A Morton curve interleaves the
bits of several columns' buckets, so rows that are near in all of them lie together and the minima
and maxima of row groups prune filters on each. Buckets are quantiles, so a hot value does not
crowd the curve, and rows of one cell are still divided among files by their hash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.sources.marts import read_parquet

#: Bits of the curve taken from each column: 64 buckets each.
BITS = 6
#: Precision of the sketched quantiles; a rank is off by at most rows / ACCURACY.
ACCURACY = 10_000

_CURVE, _SPREAD = "_curve", "_spread"


def _number(df: DataFrame, column: str) -> Column:
    """The column as a double in its own order."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    raise ValueError(f"{column} is of type {kind.simpleString()}; a curve takes numbers, dates and times")


def splits(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Bucket borders of each column: at most ``2**bits - 1`` sketched quantiles, one scan of these columns.

    Equal borders (a hot value) are kept once, so such a column has fewer buckets. Nulls and NaN count for none.
    """
    at = F.lit([k / 2**bits for k in range(1, 2**bits)])
    real = {c: F.nanvl(_number(df, c), F.lit(None).cast("double")) for c in columns}
    found = df.agg(*[F.percentile_approx(real[c], at, ACCURACY).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[i] or [])) for i, c in enumerate(columns)}


def bucket(value: Column, borders: Sequence[float], first: int = 0) -> Column:
    """Number of borders that the value reaches, found by halving; null and NaN go to the first bucket."""
    if not borders:
        return F.lit(first)
    half = len(borders) // 2
    upper = bucket(value, borders[half + 1 :], first + half + 1)
    lower = bucket(value, borders[:half], first)
    return F.when((value >= borders[half]) & ~F.isnan(value), upper).otherwise(lower)


def morton(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """Bits of the buckets interleaved, highest first, the first column's before the others'."""
    if bits * len(buckets) > 62:
        raise ValueError("bits times columns must be at most 62")
    numbers = [b.cast("long") for b in buckets]
    taken = [
        F.shiftleft(F.shiftright(n, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(numbers) + len(numbers) - 1 - i)
        for i, n in enumerate(numbers)
        for bit in range(bits)
    ]
    return reduce(Column.bitwiseOR, taken)


def along_curve(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    bits: int = BITS,
    files: int | None = None,
    borders: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """The rows ranged and sorted by the partition columns, then along the curve.

    One range shuffle, in ``files`` ranges or as many as adaptive execution finds right. Rows of
    one cell may be any share of the table: the hash of the row, last of the range keys, divides them.
    """
    if not columns:
        raise ValueError("a curve needs a column")
    for name in (_CURVE, _SPREAD):
        if name in df.columns:
            raise ValueError(f"column {name} is taken")
    borders = borders or splits(df, columns, bits)
    curve = morton([bucket(_number(df, c), borders[c]) for c in columns], bits)
    hashable = [f"`{f.name}`" for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.DatetimeType))]
    keyed = df.withColumns({_CURVE: curve, _SPREAD: F.xxhash64(*hashable)})
    order = [*[F.col(f"`{c}`") for c in partition_by], F.col(_CURVE), F.col(_SPREAD)]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order[:-1]).drop(_CURVE, _SPREAD)


def write_along_curve(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    bits: int = BITS,
    files: int | None = None,
    row_group_bytes: int | None = None,
    only_these_partitions: bool = False,
    borders: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Write a Parquet table along the curve of ``columns`` and return it read back.

    The input is scanned for the borders, for the ranges and for the rows; store it first if it is
    expensive. ``row_group_bytes`` is Parquet's size of a row group (128 MB if not given).
    """
    out = along_curve(df, columns, partition_by, bits, files, borders)
    writer = out.write.mode("overwrite").partitionBy(*partition_by)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_these_partitions else "static")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)
