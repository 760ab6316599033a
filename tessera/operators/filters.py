"""Row filters. Simple comparisons on input columns are pushed into the
Parquet scan (``PushedFilters``) by Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tessera.functions.columns import qcol
from tessera.functions.nulls import any_present


def not_null(df: DataFrame, column: str) -> DataFrame:
    """``WHERE column IS NOT NULL``."""
    return df.where(qcol(column).isNotNull())


def any_of_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``WHERE NOT (a IS NULL AND b IS NULL ...)``."""
    return df.where(any_present(list(columns)))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """``WHERE column = value``."""
    return df.where(qcol(column) == value)


def at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Quality threshold: ``WHERE column >= threshold`` (NULL is rejected)."""
    return df.where(qcol(column) >= threshold)
