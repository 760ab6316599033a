"""Row number per key and "keep the latest row per key".

``row_number() OVER (PARTITION BY key ORDER BY ts DESC)`` filtered to 1 is
planned by Spark as a ``WindowGroupLimit``: a partial limit runs in every map
task *before* the shuffle, so each task sends at most one row per key, and a
key that holds a large share of all rows costs one row per task in the
exchange, not all of its rows.

A full numbering (every row keeps its number) cannot be cut short like that. It
has two strategies with the same result; the caller names one, nothing is
measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import fresh_names, has_map, qcol
from tessera.scratch import Scratch, shuffle_partitions

# Bytes of input per piece of the "pieces" strategy.
PIECE_BYTES = 128 * 1024 * 1024


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order(order_by: Sequence[str], descending: bool) -> list[Column]:
    # Newest first, rows without a timestamp last (as DESC orders in SQL).
    return [qcol(c).desc_nulls_last() if descending else qcol(c).asc_nulls_last() for c in order_by]


def _row_hash(df: DataFrame) -> Column:
    """Decides ties: a hash of the row (maps can't be hashed and stay out)."""
    return F.xxhash64(*[qcol(f.name) for f in df.schema.fields if not has_map(f.dataType)])


def row_number_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    descending: bool = True,
    rank_col: str = "rn",
    strategy: str = "window",
    pieces: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (bigint): 1 for the first row of each key by ``order_by``.

    Rows that tie are numbered by a hash of the row, then, when they are the
    same in every column, in any order; both strategies number alike.

    ``strategy="window"`` is one shuffle by key, with all rows of a key in one
    task. ``strategy="pieces"`` is for a key that holds more rows than a task
    should take: the rows are cut into ordered pieces by (key, order), at most
    a piece in one task whatever the keys hold, numbered inside, and shifted by
    what the same key has in earlier pieces. It writes the input twice to the
    shared folder. ``pieces`` is their number (default: by the input's size).
    """
    keys, orders = _as_list(key), _as_list(order_by)
    if strategy == "window":
        (tie,) = fresh_names(df, 1)
        window = Window.partitionBy(*map(qcol, keys)).orderBy(*_order(orders, descending), F.col(tie))
        numbered = df.withColumn(tie, _row_hash(df)).withColumn(rank_col, F.row_number().over(window).cast("long"))
        return numbered.drop(tie)
    if strategy != "pieces":
        raise ValueError(f"strategy must be 'window' or 'pieces', not {strategy!r}")
    return _row_number_in_pieces(df, keys, orders, descending, rank_col, pieces)


def _row_number_in_pieces(
    df: DataFrame, keys: list[str], order_by: list[str], descending: bool, rank_col: str, pieces: int | None
) -> DataFrame:
    """1. Give every row a hash and a number, and write that: both stay the same
          however often a later task runs.
    2. Range-partition on (key, order, hash, number) and write each row with its
       piece; a key, or rows that are all the same, are cut like others.
    3. Number the rows of each (key, piece), and add the rows that the key has
       in earlier pieces, by a join on (key, piece). Only a key cut by a boundary
       has any, so there are fewer such pairs than pieces.
    """
    spark = df.sparkSession
    tie, row, piece, local, before, *aliases = fresh_names(df, 5 + len(keys))
    n = pieces or shuffle_partitions(df, PIECE_BYTES)
    key_cols = [qcol(k) for k in keys]
    order = [*_order(order_by, descending), F.col(tie).asc(), F.col(row).asc()]
    with Scratch(spark) as scratch:
        marked = scratch.table(df.withColumn(tie, _row_hash(df)).withColumn(row, F.monotonically_increasing_id()), "rows")
        cut = marked.repartitionByRange(n, *[k.asc_nulls_last() for k in key_cols], *order)
        cut = scratch.keep(cut.withColumn(piece, F.spark_partition_id()), "pieces")
        sizes = cut.groupBy(*[k.alias(a) for k, a in zip(key_cols, aliases)], piece).agg(F.count("*").alias(local))
        earlier = Window.partitionBy(*aliases).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
        shifts = sizes.withColumn(before, F.sum(local).over(earlier)).where(F.col(before) > 0)
        shifts = scratch.keep(shifts.select(*aliases, F.col(piece).alias(tie), before), "shifts")
    window = Window.partitionBy(*key_cols, piece).orderBy(*order)
    numbered = cut.withColumn(local, F.row_number().over(window)).drop(tie, row)
    match = F.col(piece) == F.col(tie)
    for k, a in zip(key_cols, aliases):
        match = match & k.eqNullSafe(F.col(a))
    joined = numbered.join(shifts, match, "left")
    rank = (F.col(local) + F.coalesce(F.col(before), F.lit(0))).cast("long")
    return joined.select(*[qcol(c) for c in df.columns], rank.alias(rank_col))


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    descending: bool = True,
) -> DataFrame:
    """Keep the first row of each key by ``order_by`` (default: newest)."""
    (rank,) = fresh_names(df, 1)
    w = Window.partitionBy(*[qcol(k) for k in _as_list(key)]).orderBy(*_order(_as_list(order_by), descending))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)
