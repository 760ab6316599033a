"""Column profiles that merge: kept for every snapshot, joined across them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import resolve
from tessera.functions.numeric import null_rate
from tessera.operators.unpivot import SLOT, lookup, typed_rows
from tessera.sources.schema import sql_type_name

#: log2 of a sketch's registers; its relative standard error is 1.04 / sqrt(2 ** LG).
LG = 14
ERROR = 1.04 / 2 ** (LG / 2)


def profile_state(df: DataFrame, columns: Sequence[str] | None = None, lg: int = LG) -> DataFrame:
    """What a profile needs, a row to a column: position, column, type,
    total_rows, non_null_rows, sketch (HyperLogLog of the values).

    One job over ``df``; a sketch takes the 64-bit hash of a value's type-true
    encoding, so equal values of integers of any width count once across
    snapshots. Store it beside the snapshot (:func:`tessera.sources.parquet.write_parquet`).
    """
    cols = [resolve(df, c) for c in columns] if columns is not None else list(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    rows, values, _ = typed_rows(df, cols)
    spark = df.sparkSession
    nulls = [F.lit(None).cast(rows.schema[v].dataType).alias(v) for v in values]
    empty = spark.range(len(cols)).select(F.col("id").cast("int").alias(SLOT), *nulls, F.lit(0).alias("_w"))
    weighted = rows.withColumn("_w", F.lit(1)).unionByName(empty)
    present = F.coalesce(*[F.when(F.col(v).isNotNull(), F.lit(True)) for v in values]).isNotNull()
    stats = weighted.groupBy(SLOT).agg(
        F.sum("_w").cast("long").alias("total_rows"),
        F.sum(F.when(present, F.col("_w")).otherwise(0)).cast("long").alias("non_null_rows"),
        F.hll_sketch_agg(F.when(present, F.xxhash64(*values)), F.lit(lg)).alias("sketch"),
    )
    kind = [sql_type_name(types[c]) for c in cols]
    return stats.select(F.col(SLOT).alias("position"), lookup(cols).alias("column"), lookup(kind).alias("type"), "total_rows", "non_null_rows", "sketch")


def merged_profile(states: DataFrame) -> DataFrame:
    """The profile of all rows behind ``states`` (several of :func:`profile_state`,
    as of the snapshots of a history), a row to a column name: column, type (the
    smallest name, if they differ), total_rows, non_null_rows, null_rate, all
    exact, and distinct_values within the sketches' error. No snapshot is read."""
    merged = states.groupBy("column").agg(
        F.min("type").alias("type"), F.sum("total_rows").alias("total_rows"), F.sum("non_null_rows").alias("non_null_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
    return merged.select("column", "type", "total_rows", "non_null_rows", null_rate(F.col("total_rows"), F.col("non_null_rows")).alias("null_rate"), "distinct_values")
