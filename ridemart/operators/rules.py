"""Named row conditions, and the three things done with a list of them.

A rule says what a *good* row satisfies. Conditions follow SQL logic: a null operand makes
the condition unknown, and an unknown rule does not hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions.numeric import percent


@dataclass(frozen=True)
class Rule:
    """A label and a condition; the condition is built when a plan is."""

    label: str
    condition: Callable[[], Column]


def above(column: str, bound, label: str | None = None) -> Rule:
    return Rule(label or f"{column} > {bound}", lambda: F.col(column) > bound)


def below(column: str, bound, label: str | None = None) -> Rule:
    return Rule(label or f"{column} < {bound}", lambda: F.col(column) < bound)


def at_least(column: str, bound, label: str | None = None) -> Rule:
    return Rule(label or f"{column} >= {bound}", lambda: F.col(column) >= bound)


def at_most(column: str, bound, label: str | None = None) -> Rule:
    return Rule(label or f"{column} <= {bound}", lambda: F.col(column) <= bound)


def one_of(column: str, values: Sequence, label: str | None = None) -> Rule:
    return Rule(label or f"{column} in {list(values)}", lambda: F.col(column).isin(*values))


def all_hold(rules: Sequence[Rule]) -> Column:
    """Conjunction; plain comparisons stay separate conjuncts and reach the Parquet scan."""
    return reduce(lambda a, b: a & b, [rule.condition() for rule in rules])


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(all_hold(rules))


def first_broken(rules: Sequence[Rule]) -> Column:
    """Struct (reason, outcome) of the first rule that fails or is unknown, null if none."""

    def broken(rule: Rule) -> Column:
        holds = rule.condition()
        outcome = F.when(holds.isNull(), "null").otherwise("failed")
        return F.when(
            ~F.coalesce(holds, F.lit(False)),
            F.struct(F.lit(rule.label).alias("reason"), outcome.alias("outcome")),
        )

    return F.coalesce(*[broken(rule) for rule in rules])


def mark_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reason`` and ``outcome``, both null on rows every rule accepts."""
    marked = df.withColumn("_broken", first_broken(rules))
    return marked.withColumns(
        {"reason": F.col("_broken.reason"), "outcome": F.col("_broken.outcome")}
    ).drop("_broken")


def count_matches(
    df: DataFrame,
    conditions: Sequence[Rule],
    label: str = "check_name",
    count: str = "records",
    share: str = "pct",
) -> DataFrame:
    """Rows matching each condition and their share of all rows, one output row per condition.

    All conditions are counted in one scan with one conditional aggregate; a single row
    per task is shuffled.
    """
    hits = [F.count_if(c.condition()).alias(f"hit_{i}") for i, c in enumerate(conditions)]
    counted = df.agg(F.count(F.lit(1)).alias("all_rows"), *hits)
    arms = F.array(
        *[
            F.struct(F.lit(c.label).alias(label), F.col(f"hit_{i}").alias(count))
            for i, c in enumerate(conditions)
        ]
    )
    return counted.select("all_rows", F.inline(arms)).select(
        label, count, percent(F.col(count), F.col("all_rows"), 4).alias(share)
    )
