"""Exact summary statistics of many numeric columns in two scans, safe for any column.

Built-in exact ``percentile`` sends every task's value counts of a column to a single task. Here
no values move until the few that matter are known:

1. one aggregate gives count, extremes, mean, deviation and a mergeable quantile sketch (KLL) of
   every metric; the sketch brackets each wanted rank between two values;
2. a second pass counts rows below, between and inside the brackets. Only values inside one are
   grouped by value, which combines on the map side, and only those of the slices of a bracket
   that hold a wanted rank are ordered.

The result is exact whatever the sketch says: a rank that its bracket misses is found by
repeating the second pass for that metric with a wider bracket. Per metric and probability two
bounds and at most two values reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.functions.numeric import as_col

#: Size of the sketch and the rank error it keeps to nearly always, as a share of the rows.
SKETCH = 8_192
SKETCH_ERROR = 2.5 / SKETCH**0.9
#: Errors to either side of a rank that its bracket spans at first, and the factor it grows by.
MARGIN, WIDER = 3.0, 8.0
#: Slices of a bracket; the values of one slice are ordered by one task.
SLICES = 4_096


@dataclass(frozen=True)
class Bracket:
    """Values from ``low`` to ``high``, both inside; None is open."""

    low: float | None
    high: float | None


def merged(brackets: Sequence[Bracket]) -> list[Bracket]:
    """Disjoint brackets in order that cover the given ones."""
    out: list[Bracket] = []
    for b in sorted(brackets, key=lambda b: -math.inf if b.low is None else b.low):
        last = out[-1] if out else None
        if last is not None and (last.high is None or b.low is None or b.low <= last.high):
            high = None if last.high is None or b.high is None else max(last.high, b.high)
            out[-1] = Bracket(last.low, high)
        else:
            out.append(b)
    return out


def sketched(wide: DataFrame, shares: Sequence[float], errors: float) -> DataFrame:
    """One row with a struct per column: statistics, and ``low`` and ``high`` values for each share.

    The bounds are the sketch's values ``errors`` shares of the rows below and above.
    """
    def bounds(sketch: Column, by: float) -> Column:
        at = F.array(*[F.lit(min(1.0, max(0.0, p + by))) for p in shares])
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, at))

    parts = {"count": F.count, "min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev}
    found = wide.agg(
        *[
            F.struct(
                *[f(F.col(f"`{c}`")).alias(n) for n, f in parts.items()],
                F.kll_sketch_agg_double(F.col(f"`{c}`"), F.lit(SKETCH)).alias("sketch"),
            ).alias(f"m{i}")
            for i, c in enumerate(wide.columns)
        ]
    )
    return found.select(
        *[
            F.struct(
                *[F.col(f"m{i}.{n}").alias(n) for n in parts],
                bounds(F.col(f"m{i}.sketch"), -errors).alias("low"),
                bounds(F.col(f"m{i}.sketch"), errors).alias("high"),
            ).alias(f"m{i}")
            for i in range(len(wide.columns))
        ]
    )


def _place(value: Column, brackets: Sequence[Bracket]) -> Column:
    """2k + 1 for values inside the k-th bracket, 2k for those before it and after all others."""
    out = F.lit(2 * len(brackets))
    for k, b in reversed(list(enumerate(brackets))):
        # NaN is the largest value, so an open bracket at the top takes it in.
        if b.high is not None:
            out = F.when(value <= F.lit(b.high), 2 * k + 1).otherwise(out)
        else:
            out = F.lit(2 * k + 1)
        if b.low is not None:
            out = F.when(value < F.lit(b.low), 2 * k).otherwise(out)
    return out


def _slice(value: Column, brackets: Sequence[Bracket], low: float, high: float) -> Column:
    """Which equal part of its bracket a value lies in; 0 where the bracket has no finite width."""
    out = F.lit(0)
    for b in brackets:
        a, z = (low if b.low is None else b.low), (high if b.high is None else b.high)
        if z > a and math.isfinite(z - a):
            part = F.least(F.floor((value - F.lit(a)) / F.lit(z - a) * SLICES), F.lit(SLICES - 1))
            inside = F.lit(True)
            if b.low is not None:
                inside &= value >= F.lit(b.low)
            if b.high is not None:
                inside &= value <= F.lit(b.high)
            out = F.when(inside, part.cast("int")).otherwise(out)
    return out


def located(
    wide: DataFrame, brackets: Mapping[str, Sequence[Bracket]], ranks: Mapping[str, Sequence[int]], spans: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """(metric, rank, value) of every wanted rank that lies inside a bracket of its metric.

    Ranks count from 0 over the column's rows. ``spans`` has each column's least and greatest value.
    """
    # Each column's place is worked out once, before the slots and values that use it.
    names = list(brackets)
    placed = wide.select("*", *[_place(F.col(f"`{m}`"), brackets[m]).alias(f"place {i}") for i, m in enumerate(names)])
    entries = []
    for i, name in enumerate(names):
        value, place = F.col(f"`{name}`"), F.col(f"`place {i}`")
        inside = place % 2 == 1
        slot = place.cast("long") * SLICES + F.when(inside, _slice(value, brackets[name], *spans[name])).otherwise(0)
        entries.append(
            F.struct(F.lit(name).alias("metric"), F.when(value.isNotNull(), slot).alias("slot"), F.when(inside, value).alias("value"))
        )
    long = placed.select(F.inline(F.array(*entries))).filter("slot IS NOT NULL")
    counted = long.groupBy("metric", "slot", "value").agg(F.count(F.lit(1)).alias("rows"))
    # Slots are few, so their running count orders at most some thousand rows a metric. Whether a
    # slot is inside is an aggregate: a condition on the key would reach one use of ``counted``
    # only, and its exchange could not be used by both.
    odd = F.max(F.expr(f"slot div {SLICES} % 2")).alias("odd")
    slots = counted.groupBy("metric", "slot").agg(F.sum("rows").alias("rows"), odd)
    so_far = W.unboundedPreceding, W.currentRow
    before = F.sum("rows").over(W.partitionBy("metric").orderBy("slot").rowsBetween(*so_far))
    wanted = F.create_map(*[x for m, r in ranks.items() for x in (F.lit(m), F.array(*[F.lit(k).cast("long") for k in r]))])
    chosen = (
        slots.withColumn("before", before - F.col("rows"))
        .withColumn("wanted", F.filter(wanted[F.col("metric")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rows"))))
        .filter("odd = 1 AND size(wanted) > 0")
        .drop("rows", "odd")
    )
    upto = F.col("before") + F.sum("rows").over(W.partitionBy("metric", "slot").orderBy("value").rowsBetween(*so_far))
    return (
        counted.join(F.broadcast(chosen), ["metric", "slot"])  # a row for each wanted rank at most
        .withColumn("upto", upto)
        .select("metric", "value", "rows", "upto", F.explode("wanted").alias("rank"))
        .filter("rank < upto AND rank >= upto - rows")
        .select("metric", "rank", "value")
    )


def summarise(
    df: DataFrame,
    metrics: Mapping[str, Column | str],
    probabilities: Mapping[str, float],
    errors: float = MARGIN * SKETCH_ERROR,
) -> DataFrame:
    """Per metric: count, min, max, mean, sample stddev and interpolated quantiles.

    ``metrics`` maps an output name to an expression; nulls do not count, so a per-metric
    filter is written as a ``when`` without ``otherwise``. ``probabilities`` maps an output
    column to a probability. A metric with no values gives one row with count 0. NaN counts as
    the largest value. The two passes run when this is called; the result has a row per metric.
    """
    wide = df.select(*[as_col(c).cast("double").alias(name) for name, c in metrics.items()])
    shares = list(probabilities.values())
    stats = {name: row for name, row in zip(metrics, sketched(wide, shares, errors).first() or (), strict=True)}
    found: dict[tuple[str, int], float] = {}
    places = {name: [p * (row["count"] - 1) for p in shares] for name, row in stats.items() if row["count"]}
    open_ranks = {name: sorted({f(x) for x in at for f in (math.floor, math.ceil)}) for name, at in places.items()}
    brackets = {name: _first_brackets(stats[name], shares, errors) for name in places}
    while open_ranks:
        spans = {name: (stats[name]["min"], stats[name]["max"]) for name in open_ranks}
        some = {name: merged(brackets[name]) for name in open_ranks}
        for row in located(wide.select(*[f"`{m}`" for m in open_ranks]), some, open_ranks, spans).collect():
            found[row["metric"], row["rank"]] = row["value"]
        open_ranks = {name: left for name, r in open_ranks.items() if (left := [k for k in r if (name, k) not in found])}
        brackets = {name: [_wider(b, *spans[name]) for b in brackets[name]] for name in open_ranks}
    rows = []
    for name, row in stats.items():
        values = []
        for at in places.get(name, [None] * len(shares)):
            if at is None:
                values.append(None)
            else:
                low, high = found[name, math.floor(at)], found[name, math.ceil(at)]
                values.append(low + (high - low) * (at - math.floor(at)))
        rows.append((name, *[row[c] for c in ("count", "min", "max", "mean", "stddev")], *values))
    names = ", ".join(f"`{n}` double" for n in probabilities)
    return df.sparkSession.createDataFrame(rows, f"metric string, count long, min double, max double, mean double, stddev double{names and ', '}{names}")


def _first_brackets(row, shares: Sequence[float], errors: float) -> list[Bracket]:
    """The sketch's bounds; open where they reach beyond the first or last row."""
    bounds = zip(shares, row["low"] or [None] * len(shares), row["high"] or [None] * len(shares), strict=True)
    return [Bracket(None if p <= errors else low, None if p >= 1 - errors else high) for p, low, high in bounds]


def _wider(bracket: Bracket, low: float, high: float) -> Bracket:
    """The bracket grown to either side; open once it leaves the column's values or cannot grow."""
    if bracket.low is None or bracket.high is None:
        return Bracket(None, None)
    by = max(bracket.high - bracket.low, (high - low) / SLICES, abs(bracket.high) * 1e-9) * WIDER
    a, z = bracket.low - by, bracket.high + by
    return Bracket(a if math.isfinite(by) and a > low else None, z if math.isfinite(by) and z < high else None)


def approximate_quantiles(
    df: DataFrame, metrics: Mapping[str, Column | str], probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Optional cheaper form: sketch quantiles (no interpolation), one scan, one small state."""
    return df.agg(
        *[
            F.percentile_approx(as_col(c), list(probabilities), accuracy).alias(name)
            for name, c in metrics.items()
        ]
    )
