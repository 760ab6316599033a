"""Counts and ranges of Parquet data from file footers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol, resolve
from tessera.session import session_conf
from tessera.sources.versions import current_version

#: Types whose smallest and largest values the footers hold exactly. (They
#: leave out NaN, and write 0.0 as -0.0 where it is the smallest.)
RANGED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row to a column: column, total_rows, non_null_rows, min_value and
    max_value (text; NULL for types that footers have no exact range of: floats,
    text, timestamps, decimals, nested ones).

    The aggregate is pushed into the scan (``PushedAggregation`` in the plan):
    only footers are opened, whatever the data's size. It runs here, and its one
    row of numbers comes to the driver.
    """
    with session_conf(spark, PUSHED):
        row, names, types = _aggregate(spark, path, columns)
        found = row.first()
    rows = []
    for i, name in enumerate(names):
        low, high = (found[f"{side}{i}"] if isinstance(types[name], RANGED) else None for side in ("min", "max"))
        rows.append((name, found["total"] or 0, found[f"n{i}"] or 0, low, high))  # no file: NULL
    return spark.createDataFrame(rows, "column string, total_rows long, non_null_rows long, min_value string, max_value string")


def _aggregate(spark: SparkSession, path: str, columns: Sequence[str] | None):
    df = spark.read.parquet(current_version(spark, path))
    names = [resolve(df, c) for c in columns] if columns is not None else list(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.count("*").alias("total")]
    for i, name in enumerate(names):
        parts.append(F.count(qcol(name)).alias(f"n{i}"))
        if isinstance(types[name], RANGED):
            parts += [F.min(qcol(name)).alias(f"min{i}"), F.max(qcol(name)).alias(f"max{i}")]
    # as text only above the aggregate, so that it can still be pushed
    row = df.agg(*parts)
    text = [F.col(c).cast("string").alias(c) if c.startswith(("min", "max")) else F.col(c) for c in row.columns]
    return row.select(*text), names, types
