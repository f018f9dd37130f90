"""DuckDB statements that define what each registered query must return.

They are written on their own, with plain SQL functions, and share nothing with the Spark
code but column names and fixed values.
"""

from __future__ import annotations

from oracle import breakdowns, marts, model, profiles, quality, sources, verification


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in (sources, quality, profiles, breakdowns, marts, verification, model):
        out.update(module.STATEMENTS)
    return out
