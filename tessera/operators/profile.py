"""Column profile: type, row count, non-NULL count, NULL rate, distinct count.

The whole table is profiled in one job, and its input runs once: every row is
unpivoted into typed ``(slot, value)`` rows (:mod:`tessera.operators.unpivot`)
and aggregated by slot. The exact distinct count is a first aggregation on
(slot, value) - hash-partitioned on the value too, so one wide or one very
frequent column does not land in one task, and a hot value is collapsed
map-side - followed by a tiny one on the slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import resolve
from tessera.functions.numeric import null_rate
from tessera.operators.sample import sample_rows as exact_sample
from tessera.operators.unpivot import SLOT, lookup, typed_rows
from tessera.sources.schema import sql_type_name


def column_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """Per column: ``position, column, type, total_rows, non_null_rows, distinct_values``.

    ``approx`` swaps the exact distinct count for HyperLogLog++
    (``approx_count_distinct`` with relative error ``rsd``): no shuffle of
    values at all, for very wide high-cardinality tables.
    """
    cols = [resolve(df, c) for c in columns] if columns is not None else list(df.columns)
    spark = df.sparkSession
    if not cols:  # no columns to profile
        return spark.createDataFrame([], "position int, column string, type string, total_rows long, "
                                         "non_null_rows long, distinct_values long")
    types = {f.name: f.dataType for f in df.schema.fields}
    rows, values, _ = typed_rows(df, cols)
    # one weightless row per column, so a column of an empty table still gets
    # its row (counts 0) without a join after the aggregation
    nulls = [F.lit(None).cast(rows.schema[v].dataType).alias(v) for v in values]
    empty = spark.range(len(cols)).select(F.col("id").cast("int").alias(SLOT), *nulls, F.lit(0).alias("_w"))
    weighted = rows.withColumn("_w", F.lit(1)).unionByName(empty)
    present = F.coalesce(*[F.when(F.col(v).isNotNull(), F.lit(True)) for v in values]).isNotNull()
    if approx:
        distinct = F.approx_count_distinct(F.when(present, F.xxhash64(*values)), rsd)
        stats = weighted.groupBy(SLOT).agg(
            F.sum("_w").alias("total_rows"), F.sum(F.when(present, F.col("_w")).otherwise(0)).alias("non_null_rows"),
            distinct.alias("distinct_values"),
        )
    else:
        per_value = weighted.groupBy(SLOT, *values).agg(F.sum("_w").alias("_w"))
        stats = per_value.groupBy(SLOT).agg(
            F.sum("_w").alias("total_rows"), F.sum(F.when(present, F.col("_w")).otherwise(0)).alias("non_null_rows"),
            F.count_if(present).alias("distinct_values"),
        )
    return stats.select(
        F.col(SLOT).alias("position"),
        lookup(cols).alias("column"),
        lookup([sql_type_name(types[c]) for c in cols]).alias("type"),
        *[F.col(c).cast("long").alias(c) for c in ("total_rows", "non_null_rows", "distinct_values")],
    )


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    rsd: float = 0.05,
    sample_fraction: float | None = None,
    seed: int = 42,
    with_position: bool = False,
    sample_rows: int | None = None,
    sample_keys: Sequence[str] | None = None,
) -> DataFrame:
    """The column profile, in source column order:
    ``column, type, null_rate, distinct_values``.

    ``null_rate`` is ``round(1 - non_null / total, 4)`` and NULL for an empty
    table. ``sample_rows`` profiles a sample of exactly that many rows, drawn by
    ``sample_keys`` (:func:`tessera.operators.sample.sample_rows`);
    ``sample_fraction`` a Bernoulli sample, where every task samples its own rows.
    """
    src = df.sample(withReplacement=False, fraction=sample_fraction, seed=seed) if sample_fraction else df
    if sample_rows is not None:
        src = exact_sample(src, sample_rows, sample_keys, seed)
    stats = column_stats(src, columns, approx=approx, rsd=rsd)
    # One row per profiled column, sorted in a single partition; the exchange
    # below it leaves the final aggregate itself on all tasks.
    out = (
        stats.select(
            "position",
            "column",
            "type",
            null_rate(F.col("total_rows"), F.col("non_null_rows")).alias("null_rate"),
            "distinct_values",
        )
        .repartition(1)
        .sortWithinPartitions("position")
    )
    return out if with_position else out.drop("position")


def sample_fraction_for(df: DataFrame, rows: int) -> float | None:
    """Fraction that samples about ``rows`` rows (``None`` = take all).

    Counts the input first; on Parquet that count is answered from file
    footers.
    """
    total = df.count()
    if total <= rows:
        return None
    return rows / total


def profile_records(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    rsd: float = 0.05,
) -> list[dict]:
    """The profile as a list of records ``{column, type, null_rate,
    distinct_values}`` in source column order.

    The counts come from the distributed :func:`column_stats` job; only its
    result - one row per column, bounded by the schema width - reaches the
    driver, where the NULL rate is computed in Python as
    ``round(1 - non_null / total, 4)`` (``None`` for an empty table). That is
    the same double arithmetic and rounding of the exact binary value as a
    Python-side report, so even exact ties (e.g. 0.00015) come out the same.
    """
    rows = sorted(column_stats(df, columns, approx=approx, rsd=rsd).collect(), key=lambda r: r["position"])
    records = []
    for r in rows:
        total, non_null = r["total_rows"], r["non_null_rows"]
        rate = 1 - (non_null / total) if total else None
        records.append(
            {
                "column": r["column"],
                "type": r["type"],
                "null_rate": round(rate, 4) if rate is not None else None,
                "distinct_values": int(r["distinct_values"]),
            }
        )
    return records
