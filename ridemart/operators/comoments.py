"""Correlations from centred co-moments that merge, so no raw row is read twice.

A state row holds, for a group and a pair of metrics, over the rows that have both: their
number, both means, and the centred sums of squares and products. States of disjoint
rows merge exactly in arithmetic; centring keeps digits that plain sums of squares lose.

What is left of rounding is that of a mean: about 1e-16 times its size, against the spread of the
metric. A metric whose mean is a million times its spread or more should be given less a
constant near it (``F.col("x") - 1e9``), which changes no correlation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions.numeric import as_col, rounded

Pairs = Mapping[str, tuple[str, str]]


def co_moments(df: DataFrame, by: Sequence[str | Column], pairs: Mapping[str, tuple[Column | str, Column | str]]) -> DataFrame:
    """State rows of every group and pair, in one scan: by, pair, n, mean_x, mean_y, xx, xy, yy."""

    def state(name: str, x: Column | str, y: Column | str) -> Column:
        x, y = as_col(x).cast("double"), as_col(y).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        n = F.count(x)
        zero = lambda c: F.coalesce(c * n, F.lit(0.0))
        return F.struct(
            F.lit(name).alias("pair"), n.alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
            zero(F.var_pop(x)).alias("xx"), zero(F.covar_pop(x, y)).alias("xy"), zero(F.var_pop(y)).alias("yy"),
        )

    states = df.groupBy(*by).agg(F.array(*[state(name, x, y) for name, (x, y) in pairs.items()]).alias("_states"))
    return states.select(*[c for c in states.columns if c != "_states"], F.inline("_states"))


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States added up to coarser groups. Windows run over state rows, never over raw ones."""
    whole = W.partitionBy(*by, "pair")

    def mean(c: str) -> Column:
        # Means are averaged by their distance from the least one: their own size would cost digits.
        least = F.min(c).over(whole)
        return least + F.try_divide(F.sum(F.col("n") * (F.col(c) - least)).over(whole), F.sum("n").over(whole))

    off_x, off_y = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    total = lambda c, shift: F.sum(F.col(c) + F.coalesce(F.col("n") * shift, F.lit(0.0))).alias(c)
    return (
        states.withColumns({"_x": mean("mean_x"), "_y": mean("mean_y")})
        .groupBy(*by, "pair")
        .agg(
            F.sum("n").alias("n"), F.first("_x").alias("mean_x"), F.first("_y").alias("mean_y"),
            total("xx", off_x * off_x), total("xy", off_x * off_y), total("yy", off_y * off_y),
        )
    )


def correlation(digits: int | None = 4) -> Column:
    """Pearson correlation of a state row; null where a side is constant or has no rows."""
    value = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    return value if digits is None else rounded(value, digits)


def correlation_row(states: DataFrame, names: Sequence[str], digits: int | None = 4) -> DataFrame:
    """One row with a column for each pair, from the states of any set of groups."""
    each = merged(states).select("pair", correlation(digits).alias("r"))
    return each.agg(*[F.max(F.when(F.col("pair") == name, F.col("r"))).alias(name) for name in names])
