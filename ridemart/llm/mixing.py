"""Mixing sources to target weights by entropy balancing.

Sources share the corpus's words by weight, none more than ``cap`` times its own. For each
source the document rates closest to one (in relative entropy, between 0 and ``cap``) whose
words add up to the target are exponential tilts min(cap, exp(l * words / mean)). The multiplier
l solves the convex dual: its gradient, words taken less target, is driven to zero by Newton
steps inside a bracket. A step is one aggregate for all sources at once over the table of
(source, size) cells, a summary that is exact because the rate depends on nothing else.

Rates become whole copies by systematic rounding: along a source's cells in order of size the
running sum of rates is rounded, so copies follow the rates at every size; of 64 roundings
(they differ in where rounding starts) the one whose words come nearest the target is used.
Documents of a cell share its copies evenly, the remainder going by a hash of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.llm.common import n_words, numbered, stored

#: The registered mix: weights in order of source, repeating, and the most copies of a document.
WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
#: Newton steps stop when each source is within this share of its target.
TOLERANCE = 1e-7
STEPS = 60
#: Starting points tried when rates are rounded.
STARTS = 64


def _source_key(source: str) -> Column:
    """A non-null form of the source, for joins."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: source_key, source_size, docs and target.

    The cap is met by raising a common level: targets are min(cap * size, level * weight). With
    sources in order of cap * size / weight the capped ones come first, and the level is what
    they leave divided by the others' weight. Windows here run over one row per source.
    """
    by_source = sizes.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    order = F.row_number().over(W.orderBy(F.asc_nulls_last("source")))
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighted = by_source.withColumn("weight", F.get(table, (order - 1) % len(weights)))
    limit = F.col("source_size") * F.lit(float(cap))
    ranked = weighted.withColumn("limit", limit).withColumn("ratio", limit / F.col("weight"))
    everything = W.partitionBy()
    before = W.orderBy("ratio", "source_key").rowsBetween(W.unboundedPreceding, -1)
    levels = ranked.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    ).withColumn("level", F.col("left") / F.col("weights"))
    # The first source in this order that its level does not lift above its limit sets the level.
    common = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    share = F.least("limit", F.coalesce(common, F.lit(float("inf"))) * F.col("weight"))
    return levels.select("source_key", "source_size", "docs", share.alias("target"))


def rate(multiplier: Column, size: Column, mean: Column, cap: int) -> Column:
    """Copies of a document of this size, before rounding."""
    return F.least(F.lit(float(cap)), F.exp(multiplier * size / mean))


def multipliers(cells: DataFrame, wanted: DataFrame, cap: int = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """Solves the dual of every source; adds ``multiplier`` (null: every document at the cap).

    ``cells`` has source_key, size and rows; ``wanted`` comes from ``targets``. Words taken grow
    with the multiplier, so a bracket holds the root: a step that leaves it is halved into it,
    or doubled outwards while that side is still open.
    """
    at_cap = F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12)
    idle = at_cap | (F.col("source_size") == 0) | (F.col("target") <= 0)
    state = stored(
        wanted.withColumns(
            {
                "mean": F.col("source_size") / F.col("docs"),
                "multiplier": F.when(~at_cap, F.lit(0.0)),
                "low": F.lit(float("-inf")),
                "high": F.lit(float("inf")),
                "open": ~idle,
            }
        ),
        "mix_state",
    )
    for _ in range(STEPS):
        if state.filter("open").isEmpty():
            break
        at = state.filter("open").select("source_key", "multiplier", "mean")
        taken = F.col("rows") * F.col("size") * rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        free = rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap) < cap
        moments = (
            cells.join(at, "source_key")
            .groupBy("source_key")
            .agg(
                F.sum(taken).alias("words"),
                F.coalesce(F.sum(F.when(free, taken * F.col("size") / F.col("mean"))), F.lit(0.0)).alias("slope"),
            )
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        inf = F.lit(float("inf"))
        middle = (
            F.when(high == inf, F.greatest(F.lit(1.0), F.col("multiplier") * 2 + 1))
            .when(low == -inf, F.least(F.lit(-1.0), F.col("multiplier") * 2 - 1))
            .otherwise((low + high) / 2)
        )
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - gap / F.col("slope"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        # A far step is held to a few times the present scale; exp() would over- or underflow.
        near = F.abs(newton - F.col("multiplier")) <= 4 * (1 + F.abs("multiplier"))
        done = (F.abs(gap) <= F.lit(tolerance) * F.col("target")) | (
            (high - low) <= F.lit(1e-14) * (1 + F.abs("multiplier"))
        )
        moved = F.col("open") & F.col("words").isNotNull() & ~done
        state = stored(
            state.join(moments, "source_key", "left").select(
                "source_key", "source_size", "docs", "target", "mean",
                F.when(moved, F.when(inside & near, newton).otherwise(middle)).otherwise(F.col("multiplier")).alias("multiplier"),
                F.when(moved, low).otherwise(F.col("low")).alias("low"),
                F.when(moved, high).otherwise(F.col("high")).alias("high"),
                F.coalesce(moved, F.lit(False)).alias("open"),
            ),
            "mix_state",
        )
    return state.select("source_key", "source_size", "docs", "target", "mean", "multiplier")


def _rounded(cells: DataFrame, cap: int) -> DataFrame:
    """Adds ``copies`` to each cell: the copies its rows get together."""
    along = W.partitionBy("source_key").orderBy("size").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = cells.withColumn("upto", F.sum("expected").over(along))
    spans = stored(
        upto.withColumn("from", F.coalesce(F.lag("upto").over(W.partitionBy("source_key").orderBy("size")), F.lit(0.0))),
        "mix_cells",
    )

    def copies(start: Column) -> Column:
        steps = F.floor(F.col("upto") + start) - F.floor(F.col("from") + start)
        return F.least(steps, F.col("rows") * cap).cast("long")

    starts = F.array(*[F.lit((k + 0.5) / STARTS) for k in range(STARTS)])
    tried = (
        spans.withColumn("start", F.explode(starts))
        .groupBy("source_key", "start")
        .agg(F.abs(F.sum(copies(F.col("start")) * F.col("size")) - F.first("target")).alias("miss"))
        .groupBy("source_key")
        .agg(F.min(F.struct("miss", "start"))["start"].alias("start"))
    )
    return spans.join(tried, "source_key").withColumn("copies", copies(F.col("start")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: int = CAP,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row for each document: key, size, source_size, target and ``copies``.

    Size is the number of words. A null source is a source of its own; null and empty texts have
    size 0 and 0 copies, since they bring no words. Rows that agree in key, source and size are
    interchangeable. An empty table gives an empty table; other columns are not read.
    """
    sizes = stored(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), _source_key(source).alias("source_key"), n_words(text).alias("size")
        ),
        "mix_sizes",
    )
    wanted = stored(targets(sizes, weights, cap), "mix_targets")
    cells = stored(
        sizes.filter("size > 0").groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("rows")), "mix_histogram"
    )
    solved = multipliers(cells, wanted, cap)
    tilt = rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
    rated = cells.join(solved.select("source_key", "target", "multiplier", "mean"), "source_key").select(
        "source_key", "size", "rows", "target",
        (F.col("rows") * F.when(F.col("target") <= 0, 0.0).when(F.col("multiplier").isNull(), float(cap)).otherwise(tilt)).alias("expected"),
    )
    allotted = stored(_rounded(rated, cap).select("source_key", "size", "rows", "copies"), "mix_copies")

    with_cells = sizes.join(allotted, ["source_key", "size"], "left")
    uneven = (F.col("copies") % F.col("rows")) > 0
    plain = with_cells.filter(F.col("copies").isNull() | ~uneven)
    split = numbered(with_cells.filter(uneven), ["source_key", "size"], ["key"], "_place", "rows")
    each = F.floor(F.col("copies") / F.col("rows"))
    columns = ["key", "source_key", "size"]
    counted = plain.select(*columns, F.coalesce(each, F.lit(0)).cast("long").alias("copies")).union(
        split.select(*columns, (each + (F.col("_place") < F.col("copies") % F.col("rows")).cast("long")).cast("long"))
    )
    return counted.join(wanted.select("source_key", "source_size", "target"), "source_key").select(
        F.col("key").alias(key), "size", "source_size", "target", "copies"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op2: the words each document gives to the mix."""
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
