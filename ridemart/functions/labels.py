"""Code-to-text labels and the fixed tables behind them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridemart.functions.numeric import as_col

# Code tables of the trip data model.
PAYMENT_TYPES = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
RATE_CODES = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau / Westchester",
    5: "Negotiated",
    6: "Group Ride",
    99: "Unknown",
}
VENDORS = {1: "Creative Mobile Technologies", 2: "VeriFone Inc."}
DAY_NAMES = {
    0: "Sunday",
    1: "Monday",
    2: "Tuesday",
    3: "Wednesday",
    4: "Thursday",
    5: "Friday",
    6: "Saturday",
}
MONTH_NAMES = {
    1: "January",
    2: "February",
    3: "March",
    4: "April",
    5: "May",
    6: "June",
    7: "July",
    8: "August",
    9: "September",
    10: "October",
    11: "November",
    12: "December",
}
# Time bands by pickup hour, both ends included; every other hour is OFF_PEAK.
TIME_BANDS = {"morning_rush": (7, 9), "evening_rush": (16, 19)}
OFF_PEAK = "off_peak"
BAND_TITLES = {
    "morning_rush": "Morning Rush",
    "evening_rush": "Evening Rush",
    "off_peak": "Off-Peak",
}


def short(names: Mapping[int, str]) -> dict[int, str]:
    """Three-letter form of a name table."""
    return {code: name[:3] for code, name in names.items()}


def label(code: Column | str, names: Mapping, other: str | None = None) -> Column:
    """Text for a code; ``other`` (or null) for a code outside the table or a null code."""
    code = as_col(code)
    out = None
    for key, name in names.items():
        out = F.when(code == F.lit(key), name) if out is None else out.when(code == F.lit(key), name)
    return out.otherwise(F.lit(other).cast("string"))


def time_band(hour_of_day: Column | str) -> Column:
    hour_of_day = as_col(hour_of_day)
    out = None
    for name, (first, last) in TIME_BANDS.items():
        inside = hour_of_day.between(first, last)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise(OFF_PEAK)
