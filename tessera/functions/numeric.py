"""Arithmetic helpers for rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_rate(total: Column, non_null: Column, digits: int = 4) -> Column:
    """``round(1 - non_null / total, digits)``; NULL when ``total`` is 0.

    Double division, then half-up rounding. (At an exact binary tie, such as
    0.00015 to four places, Python's ``round`` can differ in the last digit.)
    """
    rate = F.lit(1.0) - non_null.cast("double") / F.nullif(total, F.lit(0)).cast("double")
    return F.round(rate, digits)


def share(part: Column, total: Column, digits: int = 4) -> Column:
    """``round(part / total, digits)``; NULL when ``total`` is 0."""
    return F.round(part.cast("double") / F.nullif(total, F.lit(0)).cast("double"), digits)
