"""Counts over the whole corpus for what single rows hold.

A row's items (words, links) are too many to join row by row. A task gathers
rows into blocks: a block has its distinct items once, with their occurrences,
and its rows refer to them by position. Items are counted and joined with the
corpus's totals once a block, so an item of every row moves once a block; the
totals of a block then meet its rows in one task. Nothing is broadcast, and a
block is bounded (or one row, if that is longer).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items, counted as often as they occur, to a block.
BLOCK_ITEMS = 1 << 21

_TAIL = [("block", pa.int64()), ("item", pa.int64()), ("n", pa.int64()), ("at", pa.binary()), ("times", pa.binary())]
_TAIL_DDL = "block long, item long, n long, at binary, times binary"


def block_ddl(fields: str) -> str:
    return f"{fields}, {_TAIL_DDL}"


class BlockBuilder:
    """Batches of one task: rows with the given fields (``at``, ``times``: their
    items by position in the block, and how often), and items (``item``, ``n``)."""

    def __init__(self, fields: list[tuple[str, pa.DataType]], limit: int = BLOCK_ITEMS):
        self.fields, self.limit = fields, limit
        self.schema = pa.schema(fields + _TAIL)
        self.block = TaskContext.get().partitionId() << 32
        self._reset()

    def _reset(self) -> None:
        self.rows: list[pa.Table] = []
        self.n_rows, self.size = 0, 0
        self.owners: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.counted: list[np.ndarray] = []

    def add(self, columns: list, owners: np.ndarray, codes: np.ndarray, counted: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Rows (a list to a field), and their items: ``owners`` numbers these
        rows from 0; ``counted`` (all) says which occurrences count."""
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, self.fields)]
        self.rows.append(pa.Table.from_arrays(arrays, names=[f for f, _ in self.fields]))
        self.owners.append(owners.astype(np.int64) + self.n_rows)
        self.codes.append(codes)
        self.counted.append(np.ones(len(codes), dtype=bool) if counted is None else counted)
        self.n_rows += len(arrays[0])
        self.size += len(codes) + len(arrays[0])
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n_rows:
            return
        items, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(self.counted), minlength=len(items)).astype(np.int64)
        width = max(1, len(items))
        cells, times = np.unique(np.concatenate(self.owners) * width + at, return_counts=True)
        cuts = np.searchsorted(cells, np.arange(self.n_rows + 1) * width).tolist()
        at, times = (cells % width).astype("<u4"), times.astype("<u4")
        rows = pa.concat_tables(self.rows).combine_chunks()
        parts = [pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in (at, times)]
        nothing = lambda size, t: pa.nulls(size, t)
        block = lambda size: pa.array(np.full(size, self.block))
        size = self.n_rows
        fields = [rows.column(f).combine_chunks() for f, _ in self.fields]
        fields = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in fields]
        yield pa.RecordBatch.from_arrays([*fields, block(size), nothing(size, pa.int64()), nothing(size, pa.int64()), *parts], schema=self.schema)
        size = len(items)
        if size:
            yield pa.RecordBatch.from_arrays(
                [*[nothing(size, t) for _, t in self.fields], block(size), pa.array(items.view(np.int64)), pa.array(n), nothing(size, pa.binary()), nothing(size, pa.binary())],
                schema=self.schema,
            )
        self._reset()
        self.block += 1


def items_of(blocks: DataFrame) -> DataFrame:
    """(block, item, n) of a written table of blocks."""
    return blocks.where("at is null").select("block", "item", "n")


def rows_of(blocks: DataFrame) -> DataFrame:
    return blocks.where("at is not null").drop("item", "n")


def item_totals(items: DataFrame) -> DataFrame:
    """(item, total) over all blocks."""
    return items.groupBy("item").agg(F.sum("n").alias("total"))


def measured_rows(blocks: DataFrame, totals: DataFrame, measures: Callable[[pa.Table], dict[str, np.ndarray]], kinds: dict[str, str]) -> DataFrame:
    """The rows of ``blocks`` with one column for each of ``kinds`` (name to
    type): the sum over a row's item occurrences of what ``measures`` gives for
    the block's items from their rows in ``totals`` (item and more columns, an
    item once)."""
    items = items_of(blocks).select(F.col("block").alias("of_block"), "item").join(totals, "item", "left")
    rows = rows_of(blocks)
    fields = [f for f in rows.columns if f not in ("block", "at", "times")]
    numpy_type = {"long": np.int64, "double": np.float64}

    def summed(of_block: pa.Table, known: pa.Table) -> pa.Table:
        known = known.take(pa.array(np.argsort(np.asarray(known.column("item")).view(np.uint64))))
        values = measures(known)
        at = [np.frombuffer(x, dtype="<u4") for x in of_block.column("at").to_pylist()]
        times = [np.frombuffer(x, dtype="<u4").astype(np.int64) for x in of_block.column("times").to_pylist()]
        out = of_block.select(fields)
        for name, kind in kinds.items():
            value = values[name].astype(numpy_type[kind])
            out = out.append_column(name, pa.array([(value[i] * t).sum() for i, t in zip(at, times)], pa.int64() if kind == "long" else pa.float64()))
        return out

    types = dict(rows.dtypes)
    ddl = ", ".join([f"{f} {types[f]}" for f in fields] + [f"{n} {k}" for n, k in kinds.items()])
    return rows.groupBy("block").cogroup(items.groupBy("of_block")).applyInArrow(summed, ddl)
