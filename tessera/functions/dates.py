"""Truncation of timestamps to reporting periods (day, week, month, ...)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

PERIODS = ("day", "week", "month", "quarter", "year")


def truncate_period(c: str | Column, unit: str) -> Column:
    """Start ``date`` of the period holding the timestamp or date.

    Weeks start on Monday (ISO). Computed with date arithmetic only, so a
    naive timestamp gives the same date in every session time zone.
    """
    unit = unit.lower()
    if unit not in PERIODS:
        raise ValueError(f"unit must be one of {PERIODS}")
    col = qcol(c) if isinstance(c, str) else c
    d = F.to_date(col)
    if unit == "day":
        return d
    if unit == "week":
        # dayofweek: Sunday = 1 ... Saturday = 7; days back to Monday.
        return F.date_sub(d, (F.dayofweek(d) + F.lit(5)) % F.lit(7))
    return F.trunc(d, unit)
