"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

The state of an index is two exact tables, one row per (line key, document) and
one per line key with its document count and largest document, plus cuckoo
filters, one per shard of the key space. A filter answers "not in my table"
without a lookup, so what it rejects never meets the exact table's join; what
it lets through is always settled there. Documents can be inserted and deleted:
both update the tables and, key by key, the filters, and a deletion brings the
lines back that only the deleted documents made repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tessera.llm._text import LOWER, SPACE, chunks, mix, span_hash
from tessera.scratch import Scratch

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys of one shard's filter, about.
SHARD_KEYS = 1 << 19
#: Filters are sent to the executors up to this many bytes; beyond it every
#: line goes to the exact join.
BROADCAST_BYTES = 64 << 20
_U64 = np.uint64


class CuckooFilter:
    """Set of 64-bit keys as 16-bit fingerprints, four to a bucket, each in one
    of two buckets. Never answers no for a key inside; keys can be removed."""

    SLOTS = 4

    def __init__(self, cells: np.ndarray):
        self.cells = cells.reshape(-1, self.SLOTS)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (0.8 * cls.SLOTS)))))
        return cls(np.zeros(buckets * cls.SLOTS, dtype=np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = len(keys)
        while True:
            out = cls.sized(size)
            if out.insert(keys):
                return out
            size = size * 2 + 1

    def _print(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(np.asarray(keys).astype(np.uint64))
        return np.maximum(h >> _U64(48), _U64(1)).astype(np.uint16), (h & _U64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64)) & _U64(len(self.cells) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = self._print(keys)
        other = self._other(bucket, prints)
        return (self.cells[bucket] == prints[:, None]).any(axis=1) | (self.cells[other] == prints[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Insert distinct keys; False (the filter is then unusable) when full."""
        prints, bucket = self._print(keys)
        rng = np.random.default_rng(len(keys))
        for tries in range(500):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = self.cells[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(int(fits.sum())), rank[fits]]
            self.cells[bucket[fits], slot] = prints[fits]
            prints, bucket, rank = prints[~fits], bucket[~fits], rank[~fits]
            if tries:  # both buckets were tried: one of each full bucket's prints makes room
                first = np.concatenate(([True], bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=bool)
                at, slot = bucket[first], rng.integers(0, self.SLOTS, size=int(first.sum()))
                evicted = self.cells[at, slot]
                self.cells[at, slot] = prints[first]
                prints[first] = evicted
            bucket = self._other(bucket, prints)
        return not len(prints)

    def delete(self, keys: np.ndarray) -> None:
        """Remove distinct keys that are inside."""
        for p, b, o in zip(*(x.tolist() for x in (lambda f, b: (f, b, self._other(b, f)))(*self._print(keys)))):
            for at in (b, o):
                hit = np.flatnonzero(self.cells[at] == p)
                if len(hit):
                    self.cells[at, hit[0]] = 0
                    break


# -- line keys -------------------------------------------------------------------

_REF = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("lines", pa.list_(pa.int32()))])


def _refs(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for lo, hi, buf, offs in chunks(batch.column(1)):
                breaks = np.flatnonzero(buf == 0x0A)
                docs = np.concatenate((np.searchsorted(offs, breaks, side="right") - 1, np.arange(hi - lo)))
                ends = np.concatenate((breaks, offs[1:]))
                order = np.lexsort((ends, docs))
                docs, ends = docs[order], ends[order]
                new = np.concatenate(([True], docs[1:] != docs[:-1]))
                starts = np.where(new, offs[docs], np.concatenate(([0], ends[:-1] + 1)))
                number = np.arange(len(docs)) - np.searchsorted(docs, docs)
                # without the white space at both ends
                solid = np.append(np.flatnonzero(~SPACE[buf]), len(buf))
                a = np.minimum(solid[np.searchsorted(solid[:-1], starts)], ends)
                b = np.searchsorted(solid[:-1], ends) - 1
                b = np.where(b >= 0, solid[np.maximum(b, 0)] + 1, 0)
                points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
                b = np.maximum(a, b)
                long_ = points[b] - points[a] >= min_chars
                docs, number, a, b = docs[long_], number[long_], a[long_], b[long_]
                low = LOWER[buf]
                k1, k2 = (h.spans(h.prefix(low), a, b).view(np.int64) for h in (span_hash(31), span_hash(37)))
                order = np.lexsort((number, k2, k1, docs))
                docs, number, k1, k2 = docs[order], number[order], k1[order], k2[order]
                head = np.ones(len(docs), dtype=bool)
                head[1:] = (docs[1:] != docs[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
                lists = pa.ListArray.from_arrays(pa.array(np.append(np.flatnonzero(head), len(docs)).astype(np.int32)), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(k1[head]), pa.array(k2[head]), pa.array(ids[lo:hi][docs[head]]), lists], schema=_REF)

    return run


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id, lines): per document and line key of at least
    ``min_chars`` code points, the numbers of its lines (from 0). The key is a
    128-bit hash of the line without white space at its ends, A-Z lower-cased."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return source.where("doc_id is not null").mapInArrow(_refs(min_chars), "k1 long, k2 long, doc_id long, lines array<int>")


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


# -- filters ---------------------------------------------------------------------


def _shard(shards: int):
    return F.pmod("k1", F.lit(shards)).cast("int").alias("shard")


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, cells): a cuckoo filter of the distinct keys (k1, k2) of each shard."""

    def run(table: pa.Table) -> pa.Table:
        cells = CuckooFilter.of(np.asarray(table.column("k2"))).cells
        return pa.table({"shard": table.column("shard")[:1].cast(pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

    return keys.select(_shard(shards), "k2").groupBy("shard").applyInArrow(run, "shard int, cells binary")


def update_filters(filters: DataFrame, added: DataFrame, removed: DataFrame, shards: int) -> DataFrame:
    """``filters`` after inserting the new keys ``added`` and deleting ``removed``;
    a shard whose filter overflows comes back as null cells, to be rebuilt."""
    moves = added.select(_shard(shards), "k2", F.lit(True).alias("added")).unionByName(
        removed.select(_shard(shards), "k2", F.lit(False).alias("added"))
    )

    def run(old: pa.Table, new: pa.Table) -> pa.Table:
        shard = (old if old.num_rows else new).column("shard")[:1].cast(pa.int32())
        keys, plus = np.asarray(new.column("k2")), np.asarray(new.column("added"))
        if old.num_rows:
            out = CuckooFilter(np.frombuffer(old.column("cells")[0].as_py(), dtype=np.uint16).copy())
            out.delete(keys[~plus])
            fits = out.insert(keys[plus])
        else:
            out, fits = CuckooFilter.of(keys[plus]), True
        return pa.table({"shard": shard, "cells": pa.array([out.cells.tobytes() if fits else None], pa.binary())})

    return filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInArrow(run, "shard int, cells binary")


def screen(refs: DataFrame, filters: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """``refs`` whose key may be inside, and those whose key is certainly not."""
    spark = refs.sparkSession
    size = filters.agg(F.sum(F.length("cells"))).first()[0] or 0
    if size > BROADCAST_BYTES:
        return refs, refs.where("false")
    sent = spark.sparkContext.broadcast({r["shard"]: r["cells"] for r in filters.collect()})  # at most BROADCAST_BYTES
    schema = StructType([*refs.schema.fields, StructField("maybe", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = {s: CuckooFilter(np.frombuffer(c, dtype=np.uint16)) for s, c in sent.value.items()}
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(batch.schema.get_field_index(k))) for k in ("k1", "k2"))
            shard, maybe = np.mod(k1, shards), np.zeros(len(k1), dtype=bool)
            for s, f in inside.items():
                at = np.flatnonzero(shard == s)
                maybe[at] = f.contains(k2[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "maybe"])

    flagged = refs.mapInArrow(run, schema)
    return flagged.where("maybe").drop("maybe"), flagged.where("not maybe").drop("maybe")


# -- the index ---------------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """refs (k1, k2, doc_id, lines), counts (k1, k2, n_docs, last_doc), filters
    (shard, cells; None until :func:`with_filters`) over the keys of ``counts``."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame | None = None
    shards: int = 1


def build_index(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> LineIndex:
    """The exact tables of ``docs`` (each doc_id once)."""
    refs = scratch.table(line_refs(docs, min_chars), "line-refs")
    return LineIndex(refs, scratch.table(_counts(refs), "line-counts"))


def with_filters(index: LineIndex, scratch: Scratch) -> LineIndex:
    shards = 1 + index.counts.count() // SHARD_KEYS
    return LineIndex(index.refs, index.counts, scratch.table(build_filters(index.counts, shards), "line-filters"), shards)


def _filters_after(index: LineIndex, counts: DataFrame, added: DataFrame, removed: DataFrame, scratch: Scratch) -> DataFrame:
    filters = scratch.table(update_filters(index.filters, added, removed, index.shards), "line-filters")
    full = filters.where("cells is null").select("shard")
    if full.isEmpty():
        return filters
    again = build_filters(counts.join(full, _full_shard(index.shards, full), "left_semi"), index.shards)
    return scratch.table(filters.where("cells is not null").unionByName(again), "line-filters")


def _full_shard(shards: int, full: DataFrame):
    return F.pmod("k1", F.lit(shards)).cast("int") == full["shard"]


def insert(index: LineIndex, docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> LineIndex:
    """``index`` with further documents (ids that it doesn't hold yet). Only keys
    that the filters let through meet the old counts."""
    new = scratch.table(line_refs(docs, min_chars), "line-refs")
    maybe, unseen = screen(new, index.filters, index.shards)
    plus = _counts(maybe).select("k1", "k2", F.col("n_docs").alias("p"), F.col("last_doc").alias("q"))
    merged = index.counts.join(plus, ["k1", "k2"], "full").select(
        "k1", "k2",
        (F.coalesce("n_docs", F.lit(0)) + F.coalesce("p", F.lit(0))).alias("n_docs"),
        F.greatest("last_doc", "q").alias("last_doc"),
        F.col("n_docs").isNull().alias("fresh"),
    )
    merged = scratch.table(merged.unionByName(_counts(unseen).withColumn("fresh", F.lit(True))), "line-counts")
    counts = merged.drop("fresh")
    fresh = merged.where("fresh").select("k1", "k2")
    filters = _filters_after(index, counts, fresh, fresh.where("false"), scratch)
    return LineIndex(index.refs.unionByName(new), counts, filters, index.shards)


def delete(index: LineIndex, doc_ids: DataFrame, scratch: Scratch) -> LineIndex:
    """``index`` without the documents of ``doc_ids`` (doc_id)."""
    ids = doc_ids.select("doc_id").distinct()
    gone = scratch.table(index.refs.join(ids, "doc_id", "left_semi").select("k1", "k2", "doc_id", "lines"), "line-gone")
    refs = scratch.table(index.refs.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id", "lines"), "line-refs")
    touched = gone.select("k1", "k2").distinct()
    recounted = _counts(refs.join(touched, ["k1", "k2"], "left_semi"))
    counts = scratch.table(index.counts.join(touched, ["k1", "k2"], "left_anti").unionByName(recounted), "line-counts")
    empty = touched.join(counts, ["k1", "k2"], "left_anti")
    filters = _filters_after(index, counts, empty.where("false"), empty, scratch)
    return LineIndex(refs, counts, filters, index.shards)


def repeated_lines(index: LineIndex, scratch: Scratch, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, drop): the line numbers each document loses, those with a key in
    ``min_docs`` documents or more of which it isn't the largest."""
    often = scratch.table(index.counts.where(F.col("n_docs") >= min_docs).select("k1", "k2", "last_doc"), "line-often")
    shards = 1 + often.count() // SHARD_KEYS
    maybe, _ = screen(index.refs, scratch.table(build_filters(often, shards), "line-filters"), shards)
    return (
        maybe.join(often, ["k1", "k2"])
        .where("doc_id < last_doc")
        .groupBy("doc_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drop"))
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its repeated lines dropped from ``text`` (null becomes
    empty) and the columns n_lines (before) and n_dropped added.

    A line is repeated when its key (no white space at the ends, A-Z
    lower-cased) has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents; the document with the largest doc_id among them keeps
    all its lines with that key. Other columns pass unchanged; columns named
    n_lines or n_dropped are replaced. doc_id is distinct but for repeated rows,
    which count as further documents; rows whose doc_id is null lose nothing and
    don't count. An empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        index = build_index(docs.select("doc_id", "text"), scratch, min_chars)
        drops = scratch.keep(repeated_lines(index, scratch, min_docs), "line-drops")
    drops = drops.select(F.col("doc_id").alias("_drop_id"), F.col("drop").alias("_drop"))
    # a merge join at every size: the texts are dealt by doc_id once
    joined = docs.join(drops.hint("merge"), docs["doc_id"] == drops["_drop_id"], "left")
    # the split lines are a column of their own, so that each text is split once
    joined = joined.withColumn("_text", F.coalesce("text", F.lit("")))
    joined = joined.withColumn("_lines", F.when(F.col("_drop").isNotNull(), F.split("_text", "\n", -1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_drop")
    kept = F.array_join(F.transform(kept, lambda i: F.col("_lines")[i]), "\n")
    cleaned = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(kept)
    return joined.select(
        *[cleaned.alias(c) if c == "text" else docs[c] for c in docs.columns if c not in ("n_lines", "n_dropped")],
        (F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
    )
