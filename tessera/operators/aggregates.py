"""Table-level aggregates: counts, frequencies, ranges, populations.

Every function returns a DataFrame and leaves execution to the caller. All of
them are hash aggregations with a partial (map-side) step, so a hot group is
pre-aggregated in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import qcol, resolve
from tessera.functions.dates import truncate_period
from tessera.functions.multivalue import values_of
from tessera.functions.nulls import DEFAULT_PLACEHOLDERS, placeholder_to_null
from tessera.functions.numeric import share
from tessera.operators.unpivot import SLOT, lookup, texts, typed_rows


def conditional_count(df: DataFrame, conditions: dict[str, Column], total: str | None = "total_rows") -> DataFrame:
    """``COUNT(*) FILTER (WHERE cond)`` for each named condition, in one pass."""
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.count_if(cond).cast("long").alias(name) for name, cond in conditions.items()]
    return df.agg(*aggs)


def value_frequency(
    df: DataFrame,
    column: str | Column,
    alias: str | None = None,
    count_col: str = "cnt",
    ordered: bool = True,
) -> DataFrame:
    """``GROUP BY c, COUNT(*) ORDER BY cnt DESC`` (NULL is a group of its own);
    ties are ordered by value so the output order is deterministic."""
    col = qcol(column) if isinstance(column, str) else column
    name = alias or (column if isinstance(column, str) else "value")
    freq = df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias(count_col))
    if ordered:
        freq = freq.orderBy(F.col(count_col).desc(), qcol(name).asc_nulls_last())
    return freq


def value_frequencies(
    df: DataFrame,
    columns: Sequence[str],
    top: int | None = None,
    count_col: str = "cnt",
) -> DataFrame:
    """Value frequencies of several columns in one job: ``column, value, cnt``.

    The rows are unpivoted and counted by their typed value
    (:mod:`tessera.operators.unpivot`): one run of the input and one shuffle for
    all columns, hot values combined in every map task first; only the counted
    value is turned into text. NULL is a value of its own. With ``top`` only the
    ``top`` most frequent values of each column are kept (ties by the value's
    text, ascending, NULL last): first of each hash bucket of the values, then
    of what is left, so the distinct values of one column never meet in a task.
    """
    names = [resolve(df, c) for c in columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    rows, values, home = typed_rows(df, names)
    counts = rows.groupBy(SLOT, *values).agg(F.count(F.lit(1)).alias(count_col))
    text = texts(home, [types[name] for name in names])
    counts = counts.select(SLOT, text.alias("value"), count_col, F.xxhash64(*values).alias("_hash"))
    if top is not None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col(count_col).desc(), F.col("value").asc_nulls_last()]
        for by in ([SLOT, F.pmod("_hash", F.lit(buckets))], [SLOT]):
            rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
            counts = counts.withColumn("_rank", rank).where(F.col("_rank") <= top).drop("_rank")
    return counts.select(lookup(list(columns)).alias("column"), "value", count_col)


def numeric_range(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """``MIN, MAX, AVG`` of one column (``avg`` optionally rounded)."""
    avg = F.avg(qcol(column))
    if digits is not None:
        avg = F.round(avg, digits)
    return df.agg(
        F.min(qcol(column)).alias("min_value"),
        F.max(qcol(column)).alias("max_value"),
        avg.alias("avg_value"),
    )


def key_cardinality(df: DataFrame, key: str) -> DataFrame:
    """``COUNT(*), COUNT(DISTINCT key)``: equal when the key is unique."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(qcol(key)).alias("distinct_keys"),
    )


def filtered_count(df: DataFrame, condition: Column, alias: str = "total_rows") -> DataFrame:
    """``SELECT COUNT(*) ... WHERE condition``."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(alias))


def population(
    df: DataFrame,
    columns: Sequence[str],
    placeholders: Iterable[str] = DEFAULT_PLACEHOLDERS,
    digits: int = 4,
) -> DataFrame:
    """Real population per column: rows that are neither NULL nor a placeholder.

    One row per column: ``column, total_rows, non_null_rows, populated_rows,
    population_rate``. One job and one run of the input: the columns are
    unpivoted as text and counted by slot.
    """
    names, marks = [resolve(df, c) for c in columns], list(placeholders)
    cells = [x for i, c in enumerate(names) for x in (F.lit(i), qcol(c).cast("string"))]
    pairs = df.select(F.stack(F.lit(len(names)), *cells).alias(SLOT, "v")).withColumn("_w", F.lit(1))
    # one zero-weight row per column keeps the columns of an empty table
    empty = df.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias(SLOT), F.lit(None).cast("string").alias("v"), F.lit(0).alias("_w")
    )
    v, w = F.col("v"), F.col("_w")
    stats = pairs.unionByName(empty).groupBy(SLOT).agg(
        F.sum(w).cast("long").alias("total_rows"),
        F.sum(F.when(v.isNotNull(), w).otherwise(0)).cast("long").alias("non_null_rows"),
        F.sum(F.when(placeholder_to_null(v, marks).isNotNull(), w).otherwise(0)).cast("long").alias("populated_rows"),
    )
    return (
        stats.select(SLOT, lookup(list(columns)).alias("column"), "total_rows", "non_null_rows", "populated_rows")
        .withColumn("population_rate", share(F.col("populated_rows"), F.col("total_rows"), digits))
        .repartition(1)  # one row per column
        .sortWithinPartitions(SLOT)
        .drop(SLOT)
    )


def element_frequency(
    df: DataFrame,
    column: str,
    alias: str = "value",
    sep: str = ",",
    count_col: str = "cnt",
    drop_empty: bool = False,
) -> DataFrame:
    """Rows per element of a multi-value field (products per country)."""
    elements = df.select(F.explode(values_of(df, column, sep=sep, drop_empty=drop_empty)).alias(alias))
    return elements.groupBy(alias).agg(F.count(F.lit(1)).alias(count_col))


def counts_by_period(
    df: DataFrame,
    column: str,
    unit: str,
    alias: str = "period",
    count_col: str = "cnt",
) -> DataFrame:
    """Rows per day / week / month / quarter / year of a timestamp column."""
    return (
        df.groupBy(truncate_period(column, unit).alias(alias))
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(alias).asc_nulls_last())
    )


def counts_by_periods(
    df: DataFrame,
    column: str,
    units: Sequence[str] = ("day", "week", "month"),
    count_col: str = "cnt",
) -> DataFrame:
    """Rows per period for several period lengths at once: ``unit, period, cnt``.

    One scan and one shuffle: the rows are counted per day (combined map-side
    in every task), and the per-day table - one row per distinct day, small
    whatever the data size - is rolled up to each longer period.
    """
    days = df.groupBy(truncate_period(column, "day").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    parts = [
        days.groupBy(F.lit(unit).alias("unit"), truncate_period(F.col("_day"), unit).alias("period")).agg(
            F.sum("_n").cast("long").alias(count_col)
        )
        for unit in units
    ]
    return reduce(DataFrame.unionByName, parts)
