"""NULL logic: presence tests and placeholder values that mean "missing"."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

# The placeholder strings the source uses instead of NULL in its
# categorical and grade columns.
DEFAULT_PLACEHOLDERS = ("unknown", "not-applicable")


def _as_col(c: str | Column) -> Column:
    return qcol(c) if isinstance(c, str) else c


def placeholder_to_null(c: str | Column, placeholders: Iterable[str] = DEFAULT_PLACEHOLDERS) -> Column:
    """The value, or NULL when it is one of ``placeholders`` (exact match).

    Placeholders are text, so the column's text form is compared (a no-op for
    text columns); a numeric or date column keeps its type and values.
    """
    col = _as_col(c)
    values = list(placeholders)
    if not values:
        return col
    return F.when(~col.cast("string").isin(*values), col)


def all_null(cols: Iterable[str | Column]) -> Column:
    """``a IS NULL AND b IS NULL AND ...``."""
    cond = None
    for c in cols:
        term = _as_col(c).isNull()
        cond = term if cond is None else (cond & term)
    if cond is None:
        raise ValueError("at least one column is needed")
    return cond


def any_present(cols: Iterable[str | Column]) -> Column:
    """``NOT (a IS NULL AND b IS NULL ...)``; an empty string counts as present."""
    return ~all_null(cols)
