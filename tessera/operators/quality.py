"""Data-quality checks of the curated layer, each one aggregate pass.

Results are long tables (``check, rows``) so that a report over many rules is
one small DataFrame, and a rule that finds nothing still reports 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol
from tessera.functions.nulls import all_null, any_present


def _long_table(wide: DataFrame, names: Sequence[str], label: str = "check", value: str = "rows") -> DataFrame:
    return wide.select(*[F.col(n).cast("long").alias(n) for n in names]).unpivot([], list(names), label, value)


def _per_key(df: DataFrame, key: str, counts: dict[str, Column]) -> DataFrame:
    """One row per key value (NULL included) with the given conditional
    counts and its row count ``_n``: a hash aggregation with a map-side step,
    so a hot key is one row per task before the shuffle."""
    return df.groupBy(qcol(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(cond).alias(name) for name, cond in counts.items()]
    )


def output_checks(df: DataFrame, key: str, name_columns: Sequence[str]) -> DataFrame:
    """Checks on a curated table; every count should be 0.

    * ``null_key``      - rows whose key is NULL
    * ``duplicate_key`` - rows beyond the first of their key
    * ``no_name``       - rows where every name column is NULL

    Counted per key first, then over the keys (no distinct aggregate, so no
    row is duplicated for it).
    """
    per_key = _per_key(df, key, {"_no_name": all_null(list(name_columns))})
    has_key = F.col("_key").isNotNull()
    wide = per_key.agg(
        F.sum(F.when(~has_key, F.col("_n")).otherwise(0)).alias("null_key"),
        F.sum(F.when(has_key, F.col("_n") - 1).otherwise(0)).alias("duplicate_key"),
        F.sum("_no_name").alias("no_name"),
    )
    return _long_table(wide.na.fill(0), ["null_key", "duplicate_key", "no_name"])


def reconciliation(df: DataFrame, key: str, name_columns: Sequence[str]) -> DataFrame:
    """Row accounting of the curation rules on the *input* table.

    ``rows_in - dropped_null_key - dropped_no_name - dropped_duplicate = rows_out``,
    each count reported even when it is 0. The rules apply in the curation
    order: the key and name filters first, then one row per remaining key.
    Counted per key first, then over the keys.
    """
    per_key = _per_key(
        df, key, {"_no_name": all_null(list(name_columns)), "_eligible": any_present(list(name_columns))}
    )
    has_key = F.col("_key").isNotNull()
    wide = per_key.agg(
        F.sum("_n").alias("rows_in"),
        F.sum(F.when(~has_key, F.col("_n")).otherwise(0)).alias("dropped_null_key"),
        F.sum(F.when(has_key, F.col("_no_name")).otherwise(0)).alias("dropped_no_name"),
        F.sum(F.when(has_key, F.col("_eligible")).otherwise(0)).alias("_eligible"),
        F.count_if(has_key & (F.col("_eligible") > 0)).alias("rows_out"),
    ).na.fill(0)
    wide = wide.withColumn("dropped_duplicate", F.col("_eligible") - F.col("rows_out"))
    return _long_table(wide, ["rows_in", "dropped_null_key", "dropped_no_name", "dropped_duplicate", "rows_out"])


def range_check(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Values outside ``[low, high]`` are reported, not dropped.

    One row: ``below, above, out_of_range, min_value, max_value``.
    """
    c = qcol(column)
    return df.agg(
        F.count_if(c < low).cast("long").alias("below"),
        F.count_if(c > high).cast("long").alias("above"),
        F.count_if((c < low) | (c > high)).cast("long").alias("out_of_range"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
    )


SCHEMA_CHECK = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("expected", T.StringType(), True),
        T.StructField("actual", T.StringType(), True),
        T.StructField("matches", T.BooleanType(), False),
    ]
)


def schema_check(df: DataFrame, expected_columns: Sequence[str]) -> DataFrame:
    """Column names and order against the source's; one row per position.

    Compares schemas the driver already holds; no data is read.
    """
    actual = list(df.columns)
    n = max(len(actual), len(expected_columns))
    rows = []
    for i in range(n):
        e = expected_columns[i] if i < len(expected_columns) else None
        a = actual[i] if i < len(actual) else None
        rows.append((i, e, a, e == a))
    return df.sparkSession.createDataFrame(rows, SCHEMA_CHECK)
