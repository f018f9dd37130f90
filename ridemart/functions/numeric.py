"""Numeric expressions: rounding, guarded division, rounded aggregates, number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_WHOLE = float(2**52)  # doubles from here on have no fraction


def rounded(c: Column | str, digits: int = 2) -> Column:
    """Round a double half away from zero by scale, round, unscale.

    Built-in ``round(x, 2)`` goes through the decimal text of the double and turns 1.005
    into 1.01; scaling first keeps the binary value (1.005 -> 1.0), as SQL engines that
    round in floating point do. The fraction is compared to one half, which is exact, and
    no decimal object is made per row.
    """
    scale = F.lit(float(10**digits))
    scaled = as_col(c).cast("double") * scale
    size = F.abs(scaled)
    whole = F.floor(size).cast("double")
    nearest = whole + F.when(size - whole >= 0.5, 1.0).otherwise(0.0)
    return F.when(size < _WHOLE, F.signum(scaled) * nearest).otherwise(scaled) / scale


def mean(c: Column | str, digits: int = 2) -> Column:
    return rounded(F.avg(as_col(c)), digits)


def total(c: Column | str, digits: int = 2) -> Column:
    return rounded(F.sum(as_col(c)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a rounded double; null when ``whole`` is zero."""
    return rounded(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def half_even_int(c: Column | str) -> Column:
    """Double to int rounding halves to even (a plain cast truncates)."""
    return F.rint(as_col(c)).cast("int")


def plain_text(c: Column | str) -> Column:
    """Text of a double without exponent and without grouping: 1.23456789E7 -> 12345678.9."""
    return F.call_function("format_number", as_col(c), F.lit("0.0#"))


def safe_corr(x: Column | str, y: Column | str, digits: int = 4) -> Column:
    """Pearson correlation, null (not an error) when either side is constant.

    Rows where one side is null count for neither, so the spread of each side is taken
    over complete pairs.
    """
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    pair = x.isNotNull() & y.isNotNull()
    spread_x = F.stddev(F.when(pair, x))
    spread_y = F.stddev(F.when(pair, y))
    return rounded(F.try_divide(F.covar_samp(x, y), spread_x * spread_y), digits)
