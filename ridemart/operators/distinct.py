"""Distinct counts that merge: HyperLogLog sketches beside the exact count of each group.

Exact distinct counts of days say nothing about those of a month, and counting again reads all
trips. Sketches of days merge into the sketch of any period, at a stated error.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions.numeric import as_col

#: Base-2 logarithm of a sketch's registers: 4,096 registers, about 2 KB each.
LOG_SIZE = 12
#: An estimate is taken to be within this many standard errors.
DEVIATIONS = 4


def error_bound(log_size: int = LOG_SIZE) -> float:
    """The largest relative error expected of a merged sketch."""
    return DEVIATIONS * 1.04 / math.sqrt(2**log_size)


def distinct_states(df: DataFrame, by: Sequence[str | Column], values: Mapping[str, Column | str], log_size: int = LOG_SIZE) -> DataFrame:
    """One row per group: rows, and for each value its exact count ``n_<name>`` and ``sketch_<name>``.

    Nulls count for no value. Values are told apart as text.
    """
    text = {name: as_col(v).cast("string") for name, v in values.items()}
    exact = [F.count_distinct(v).alias(f"n_{name}") for name, v in text.items()]
    sketches = [F.hll_sketch_agg(v, F.lit(log_size)).alias(f"sketch_{name}") for name, v in text.items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *exact, *sketches)


def merged(states: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Sketches of coarser groups; exact counts do not merge and are left out."""
    sketches = [c for c in states.columns if c.startswith("sketch_")]
    return states.groupBy(*by).agg(F.sum("rows").alias("rows"), *[F.hll_union_agg(c).alias(c) for c in sketches])


def estimated(states: DataFrame) -> DataFrame:
    """Sketches replaced by ``about_<name>``, the estimated number of distinct values."""
    kept = [c for c in states.columns if not c.startswith("sketch_")]
    about = [F.hll_sketch_estimate(c).alias(c.replace("sketch_", "about_", 1)) for c in states.columns if c not in kept]
    return states.select(*kept, *about)


def within_bound(about: Column | str, exact: Column | str, log_size: int = LOG_SIZE) -> Column:
    """Whether an estimate is as near to the exact count as it should be (one off is never wrong)."""
    about, exact = as_col(about), as_col(exact)
    return F.abs(about - exact) <= F.greatest(F.lit(1.0), exact * F.lit(error_bound(log_size)))
