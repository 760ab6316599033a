"""Full-file type inference for text sources.

Every column is scanned as text. The type of a column is decided from *all* of
its values, not a sample, in one distributed aggregation: the values are
unpivoted into ``(slot, v)`` pairs and grouped by slot; for each candidate type
a ``bool_and`` tells whether every non-NULL value both matches the type's
pattern and survives ``try_cast``. The first candidate that holds wins; a
column without any value stays a string.

Both tests are needed: ``try_cast('1d' AS double)`` succeeds and a pattern
cannot check a number's range or a month's length. The shuffle is tiny: the
partial aggregate leaves one row per column per input partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import qcol
from tessera.session import MAX_UNPIVOT_COLUMNS, column_chunks

# The candidate types in the order they are tried, each with the
# pattern every value must match in full. They reproduce the typing rules of the
# embedded SQL engine the pipeline was first written against: leading zeros and
# a sign of '+' keep a number text, t/f/yes/no are booleans, a time without a
# date stays text.
_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
TYPE_LATTICE: list[tuple[str, str]] = [
    ("boolean", r"(?i:true|false|t|f|yes|no)"),
    ("bigint", r" *(-\d+|0|[1-9]\d*) *"),
    ("double", r" *((-\d*|0|[1-9]\d*)?(\.\d*)?([eE][+-]?\d+)?|(?i:nan)) *"),
    ("date", _DATE),
    ("timestamp_ntz", _DATE + _TIME),
    ("timestamp", _DATE + _TIME + r"(Z|[+-]\d{2}(:?\d{2})?)?"),
    ("date:y/M/d", r"\d{4}/\d{1,2}/\d{1,2}"),
    ("date:d/M/y", r"\d{1,2}/\d{1,2}/\d{4}"),
    ("date:M/d/y", r"\d{1,2}/\d{1,2}/\d{4}"),
]


def try_type(v: Column, type_name: str) -> Column:
    """``v`` as a type of the lattice, NULL where it holds none; a type after
    ``date:`` is a date in that form."""
    kind, _, form = type_name.partition(":")
    return F.try_to_date(v, form) if form else v.try_cast(kind)


# First characters a number (or NaN) can start with, under the
# patterns above.
_NUMBER_START = (" ", "-", ".", "e", "E", "n", "N", *"0123456789")


def _gate(type_name: str, v: Column) -> Column:
    """A cheap necessary condition of ``type_name``'s pattern, tested on the
    raw string before the pattern: the pattern engine (which works on a
    converted copy of the text) and the cast run only for values that pass."""
    if type_name == "boolean":
        return F.length(v) <= 5
    if type_name in ("bigint", "double"):
        return F.substring(v, 1, 1).isin(*_NUMBER_START)
    if type_name.startswith("date:"):
        return (F.length(v) >= 8) & F.contains(v, F.lit("/"))
    # date, timestamp_ntz, timestamp: 'dddd-' first
    return (F.length(v) >= 8) & (F.substring(v, 5, 1) == F.lit("-"))


def value_checks(v: Column) -> dict[str, Column]:
    """Per candidate type: does this (non-NULL) text value hold it?

    A value holds a type when it passes the gate, matches the pattern in full
    and survives ``try_cast``. Every integer text is also a valid double and
    every naive timestamp also a valid zoned one, so those checks reuse the
    narrower one's answer first.

    The steps are nested ``CASE WHEN``s, not a chain of ``AND``s: a branch is
    evaluated only when its condition holds, whatever the optimizer does with
    repeated subexpressions, so the cast (slow when it fails) never runs on a
    value the pattern rejected. (Written as ``AND``s the same checks ran five
    times slower on lineitem text.)
    """
    no = F.lit(False)
    checks: dict[str, Column] = {}
    for type_name, pattern in TYPE_LATTICE:
        matched = F.when(v.rlike(f"^(?:{pattern})$"), try_type(v, type_name).isNotNull()).otherwise(no)
        ok = F.when(_gate(type_name, v), matched).otherwise(no)
        if type_name == "double":
            ok = checks["bigint"] | ok
        elif type_name == "timestamp":
            ok = checks["timestamp_ntz"] | ok
        checks[type_name] = ok
    return checks


def _slot(i: int) -> str:
    return f"_c{i}"


def infer_types(
    df: DataFrame,
    columns: list[str] | None = None,
    chunk_columns: int | None = MAX_UNPIVOT_COLUMNS,
) -> dict[str, str]:
    """Map each column to the Spark SQL type name inferred from all its values.

    ``df`` is normally an all-string scan. The result has one entry per column
    (the size of the schema, not of the data) and is returned to the driver.
    ``chunk_columns`` columns are unpivoted at a time, each chunk reading only
    its own columns - right for a columnar source; ``None`` takes all columns
    in one pass, for a source whose every read parses whole lines (raw text).
    """
    cols = list(columns) if columns is not None else list(df.columns)
    if not cols:
        return {}
    slots = [_slot(i) for i in range(len(cols))]
    v = F.col("v")
    checks = [F.bool_and(v.isNull() | ok).alias(type_name) for type_name, ok in value_checks(v).items()]
    # one unpivot per chunk of columns (each reads only its own columns), so
    # every stage stays within whole-stage code generation on wide tables
    parts = []
    for chunk in column_chunks(list(zip(cols, slots)), chunk_columns or max(1, len(cols))):
        text = df.select(*[qcol(c).cast("string").alias(s) for c, s in chunk])
        pairs = text.unpivot([], [s for _, s in chunk], "slot", "v")
        parts.append(pairs.groupBy("slot").agg(F.count(v).alias("n_values"), *checks))
    stats = reduce(DataFrame.unionByName, parts)
    decided: dict[str, str] = {}
    for row in stats.collect():  # one row per column
        chosen = "string"
        if row["n_values"]:
            for type_name, _ in TYPE_LATTICE:
                if row[type_name]:
                    chosen = type_name
                    break
        decided[row["slot"]] = chosen
    return {c: decided.get(s, "string") for c, s in zip(cols, slots)}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each column to its inferred type, keeping names and order."""
    out = []
    for c in df.columns:
        t = types.get(c, "string")
        col = qcol(c)
        out.append((col if t == "string" else try_type(col, t)).alias(c))
    return df.select(*out)
