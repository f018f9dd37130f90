"""Calendar expressions on zone-free timestamps.

Nothing here depends on the session time zone: every expression reads calendar fields
of a ``timestamp_ntz`` or subtracts two of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridemart.functions.numeric import as_col


def hour(ts: Column | str) -> Column:
    return F.hour(as_col(ts)).cast("long")


def month(ts: Column | str) -> Column:
    return F.month(as_col(ts)).cast("long")


def year(ts: Column | str) -> Column:
    return F.year(as_col(ts)).cast("long")


def day_of_week(ts: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(as_col(ts)) - F.lit(1)).cast("long")


def weekday(ts: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(as_col(ts)).cast("long")


def day_start(ts: Column | str) -> Column:
    """Midnight of the day, still without a zone (``date_trunc`` would add one)."""
    return as_col(ts).cast("date").cast("timestamp_ntz")


def day_distance(a: Column | str, b: Column | str) -> Column:
    """Number of midnights between a and b."""
    return F.datediff(as_col(b).cast("date"), as_col(a).cast("date")).cast("long")


def minute_boundaries(a: Column | str, b: Column | str) -> Column:
    """Number of minute marks between a and b: 00:00:59 -> 00:01:00 is 1."""
    a, b = as_col(a), as_col(b)
    return (
        day_distance(a, b) * F.lit(1440)
        + (F.hour(b) - F.hour(a)) * F.lit(60)
        + (F.minute(b) - F.minute(a))
    ).cast("long")


def elapsed_minutes(a: Column | str, b: Column | str) -> Column:
    """Exact minutes between a and b as a double."""
    gap = as_col(b) - as_col(a)
    seconds = (
        F.extract(F.lit("DAY"), gap) * F.lit(86400)
        + F.extract(F.lit("HOUR"), gap) * F.lit(3600)
        + F.extract(F.lit("MINUTE"), gap) * F.lit(60)
    ).cast("double") + F.extract(F.lit("SECOND"), gap).cast("double")
    return seconds / F.lit(60.0)


def ntz(text: str) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")
