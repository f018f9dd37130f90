"""One grouped report: counts, shares and rounded measures by any keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions.numeric import percent


def breakdown(
    df: DataFrame,
    keys: Sequence[str] | Mapping[str, Column],
    measures: Mapping[str, Column],
    *,
    count: str = "trip_count",
    share: str | None = None,
    bounded_keys: bool = False,
    top: int | None = None,
) -> DataFrame:
    """Group, count, measure, and optionally give each group's share of all input rows.

    Grouping combines on the map side first, so a key holding a third of the rows costs a
    task no more than any other key. The share needs the total on every output row:

    * ``bounded_keys``: the key domain is small by nature (hours, weekdays, codes). The
      groups themselves are summed by a window, and the input is scanned once. The caller
      promises this also for raw, unvalidated codes.
    * otherwise the groups may be many, so they stay distributed and the total comes as a
      scalar subquery that counts the input (over unfiltered Parquet, footers only).

    ``top`` keeps the largest groups, ties broken by ascending keys.
    """
    named = dict(keys) if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    counted = df.groupBy(*[c.alias(k) for k, c in named.items()]).agg(
        F.count(F.lit(1)).alias(count), *[m.alias(name) for name, m in measures.items()]
    )
    out = counted
    if share is not None:
        if bounded_keys:
            whole = F.sum(count).over(W.partitionBy())
        else:
            whole = df.agg(F.count(F.lit(1))).scalar()
        out = counted.withColumn("_all", whole).withColumn(share, percent(F.col(count), F.col("_all")))
    if top is not None:
        out = out.orderBy(F.desc(count), *[F.asc_nulls_last(k) for k in named]).limit(top)
    shares = [share] if share is not None else []
    return out.select(*named, count, *shares, *measures)


def pivot_counts(
    df: DataFrame, row: str, column: str, value: str, columns: Mapping[object, str]
) -> DataFrame:
    """Long counts to one column per listed value; a combination that never occurs is null."""
    wide = df.groupBy(row).pivot(column, list(columns)).agg(F.sum(value))
    return wide.select(row, *[F.col(f"`{code}`").alias(name) for code, name in columns.items()])


@dataclass(frozen=True)
class Cut:
    """One of several breakdowns of the same rows: its keys and which measures it shows.

    ``having`` is a condition on the keys; other groups count for no share. ``top`` keeps the largest.
    """

    keys: Sequence[str]
    measures: Sequence[str]
    share: str | None = None
    having: str | None = None
    top: int | None = None


def grouped_sets(df: DataFrame, keys: Mapping[str, Column], measures: Mapping[str, Column], cuts: Iterable[Cut], count: str) -> DataFrame:
    """All groups of all cuts in one scan: keys, ``cut_id``, the count and every measure.

    ``cut_id`` tells the grouping sets apart; a key that is not in a group's set is null. Each row
    enters every set once and combines on the map side, so what is shuffled grows with the groups.
    """
    named = df.select("*", *[c.alias(f"key {k}") for k, c in keys.items()])
    column = lambda k: F.col(f"`key {k}`")
    sets = list(dict.fromkeys(tuple(sorted(c.keys, key=list(keys).index)) for c in cuts))
    grouped = named.groupingSets([[column(k) for k in s] for s in sets], *[column(k) for k in keys]).agg(
        F.grouping_id().cast("long").alias("cut_id"), F.count(F.lit(1)).alias(count), *[m.alias(n) for n, m in measures.items()]
    )
    return grouped.select(*[column(k).alias(k) for k in keys], "cut_id", count, *measures)


def cut_of(grouped: DataFrame, keys: Sequence[str], cut: Cut, count: str) -> DataFrame:
    """One cut out of the groups of all: the table ``breakdown`` gives for it alone.

    ``keys`` are all keys of ``grouped`` in their order; the groups of a cut are few, so their total
    is a window over them.
    """
    cut_id = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cut.keys)
    out = grouped.filter(F.col("cut_id") == cut_id)
    if cut.having is not None:
        out = out.filter(cut.having)
    if cut.share is not None:
        out = out.withColumn("_all", F.sum(count).over(W.partitionBy()))
        out = out.withColumn(cut.share, percent(F.col(count), F.col("_all")))
    if cut.top is not None:
        out = out.orderBy(F.desc(count), *[F.asc_nulls_last(k) for k in cut.keys]).limit(cut.top)
    return out.select(*cut.keys, count, *([cut.share] if cut.share is not None else []), *cut.measures)
