"""Sorts, top-k and the top-N + "Other" grouping.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each task
keeps its own k best rows and only those reach the final merge, so a top-k
never moves the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

def _keys(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def sort_asc(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """``ORDER BY c`` with NULLs last (Spark's ascending default puts them first)."""
    return df.orderBy(*[qcol(c).asc_nulls_last() for c in _keys(columns)])


def top_k(
    df: DataFrame,
    order_by: str | Sequence[str],
    k: int,
    descending: bool = True,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The first ``k`` rows by ``order_by`` then ``tiebreak`` (ascending)."""
    order: list[Column] = [
        qcol(c).desc_nulls_last() if descending else qcol(c).asc_nulls_last() for c in _keys(order_by)
    ]
    order += [qcol(c).asc_nulls_last() for c in tiebreak]
    return df.orderBy(*order).limit(k)


def top_n_other(
    df: DataFrame,
    column: str | Column,
    n: int,
    label: str = "label",
    count_col: str = "cnt",
    other: str = "Other",
    nulls: str = "value",
    other_flag: str | None = None,
) -> DataFrame:
    """Counts of the ``n`` most frequent values, every other value folded into
    one ``other`` row. Ties at the cut are broken by value. ``label`` is a text
    column for any value type.

    ``nulls`` says what NULL is: ``"value"`` (one of the values, which may take
    a place), ``"other"`` (never a place, counted in the ``other`` row) or
    ``"drop"`` (not counted). A real value equal to ``other`` stays a row of
    its own when it is among the ``n``; ``other_flag`` names a boolean column
    that tells the two rows apart.

    The input is aggregated once to one row per distinct value; the top list
    (``n`` rows, a ``TakeOrderedAndProject`` over those counts) is broadcast
    back onto them, and the final aggregation is over at most ``n + 1`` rows.
    Raw rows are never joined or sorted.
    """
    if nulls not in ("value", "other", "drop"):
        raise ValueError("nulls must be 'value', 'other' or 'drop'")
    col = qcol(column) if isinstance(column, str) else column
    source = df.where(col.isNotNull()) if nulls == "drop" else df
    counts = source.groupBy(col.alias("_value")).agg(F.count(F.lit(1)).alias("_cnt"))
    places = counts.where(F.col("_value").isNotNull()) if nulls == "other" else counts
    top = (
        places.orderBy(F.col("_cnt").desc(), F.col("_value").asc_nulls_last())
        .limit(n)
        .select(F.col("_value").alias("_top_value"), F.lit(True).alias("_in_top"))
    )
    marked = counts.join(F.broadcast(top), counts["_value"].eqNullSafe(top["_top_value"]), "left")
    folded = F.col("_in_top").isNull()
    # the label is text whatever the column's type (ties above are broken on
    # the value itself, e.g. numerically)
    text = F.when(folded, F.lit(other)).otherwise(F.col("_value").cast("string"))
    rows = marked.groupBy(folded.alias("_folded"), text.alias("_label")).agg(F.sum("_cnt").cast("long").alias("_n"))
    flag = [F.col("_folded").alias(other_flag)] if other_flag else []
    return rows.select(F.col("_label").alias(label), F.col("_n").alias(count_col), *flag)
