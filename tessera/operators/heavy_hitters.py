"""The most frequent values without a shuffle of all distinct values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import qcol
from tessera.operators.topk import top_n_other

#: Values that a summary keeps; its error is at most rows * ERROR / kept.
KEPT = 65_536
#: Of Spark's frequent-items sketch: 3.5 / its table, of which three quarters are kept.
ERROR = 3.5 * 0.75


@dataclass
class HeavyHitters:
    """``rows``: label and count; ``exact_by_summary``: whether the summaries
    proved the list, else all distinct values were counted."""

    rows: DataFrame
    exact_by_summary: bool


def heavy_hitters(df: DataFrame, column: str | Column, n: int, label: str = "label", count_col: str = "cnt", other: str = "Other", kept: int = KEPT) -> HeavyHitters:
    """The ``n`` most frequent values with their exact counts, and one ``other``
    row with the rest, as :func:`tessera.operators.topk.top_n_other` gives them
    (NULL is counted in ``other``, ties go by value).

    Every task keeps a Misra-Gries summary of at most ``kept`` values (Spark's
    frequent-items sketch), and summaries are merged: that is all that moves. The
    candidates, ``4 * n`` at most, are counted exactly in one more scan, and what
    is left of the total is ``other``. A value that isn't a candidate occurs at
    most as often as the last candidate's estimate, or the summary's error, says.
    If the n-th exact count is above that, the list is proved. If not (values
    that are about equally frequent, or fewer rows than the error allows for),
    all distinct values are counted instead; the result is exact either way.
    """
    col = qcol(column) if isinstance(column, str) else column
    values = df.select(col.alias("_value"))
    wanted = min(4 * n, kept)
    found = values.where("_value is not null").agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(_value, {wanted}, {kept})").alias("top")).first()
    total = values.count()
    candidates = [(r["item"], r["count"]) for r in found["top"] or []]
    if candidates:
        # estimates are upper bounds. Listed are the values whose lower bound is above the error: what a full list
        # leaves out is no commoner than its last, what another leaves out than twice the error (nothing, if all
        # rows are on the list)
        if len(candidates) >= wanted:
            missed = candidates[-1][1]
        else:
            missed = 0 if sum(n for _, n in candidates) == found["rows"] else 2 * found["rows"] * ERROR / kept
        spark, kind = values.sparkSession, values.dtypes[0][1]
        known = spark.createDataFrame([(v,) for v, _ in candidates], values.schema)
        counts = values.join(F.broadcast(known), "_value").groupBy("_value").agg(F.count("*").alias("_n"))  # at most 4 * n values
        top = counts.orderBy(F.desc("_n"), F.asc("_value")).limit(n).collect()
        if (len(top) == n and top[-1]["_n"] > missed) or not missed:
            listed = spark.createDataFrame([tuple(r) for r in top], f"_value {kind}, _n long")
            listed = listed.select(F.col("_value").cast("string").alias(label), F.col("_n").alias(count_col))
            rest = total - sum(r["_n"] for r in top)
            if rest:
                listed = listed.unionByName(spark.createDataFrame([(other, rest)], listed.schema))
            return HeavyHitters(listed, True)
    return HeavyHitters(top_n_other(df, column, n, label, count_col, other, nulls="other"), False)
