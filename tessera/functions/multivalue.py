"""Multi-value text fields such as ``en:france,en:italy,en:spain``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol


def split_values(c: str | Column, sep: str = ",", trim: bool = False, drop_empty: bool = False) -> Column:
    """The field as an ``array<string>``.

    Like SQL ``string_split``: ``''`` gives one empty element and ``a,,b`` keeps
    the empty middle element. ``trim`` strips spaces around elements;
    ``drop_empty`` removes empty elements (an explicit option, not the default).
    """
    col = qcol(c) if isinstance(c, str) else c
    arr = F.split(col, re.escape(sep), -1)
    if trim:
        arr = F.transform(arr, lambda x: F.trim(x))
    if drop_empty:
        arr = F.filter(arr, lambda x: x != F.lit(""))
    return arr


def values_of(
    df: DataFrame, column: str, sep: str = ",", trim: bool = False, drop_empty: bool = False
) -> Column:
    """The elements of ``df[column]`` as an array: a text field is split on
    ``sep`` (:func:`split_values`); a column that already is an array is used
    as it is (``trim`` / ``drop_empty`` apply to text elements)."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.ArrayType):
        return split_values(column, sep=sep, trim=trim, drop_empty=drop_empty)
    arr = qcol(column)
    if isinstance(dtype.elementType, T.StringType):
        if trim:
            arr = F.transform(arr, lambda x: F.trim(x))
        if drop_empty:
            arr = F.filter(arr, lambda x: x != F.lit(""))
    return arr


def unnest(
    df: DataFrame,
    column: str,
    out: str | None = None,
    sep: str = ",",
    keep_nulls: bool = False,
    trim: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """One row per element of a multi-value field (split + UNNEST).

    The other columns are repeated on every element row. A NULL field yields no
    row, as UNNEST does, unless ``keep_nulls`` (then one row with a NULL
    element). The explode is a narrow, per-row operator: no shuffle.
    """
    out = out or column
    arr = values_of(df, column, sep=sep, trim=trim, drop_empty=drop_empty)
    exploded = F.explode_outer(arr) if keep_nulls else F.explode(arr)
    others = [qcol(c) for c in df.columns if c != out]
    return df.select(*others, exploded.alias(out))
