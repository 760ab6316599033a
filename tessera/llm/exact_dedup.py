"""Exact dedup with two-pass Bloom filtering.

Pass one sets bits for every text's digest and keeps those that are set twice:
each input partition sends only its bit positions, combined by position. Pass
two tests every digest against the bits set twice. A text whose bits are not
all among them is certainly unique and passes straight through; only the rest,
the repeated texts and a few false positives, is shuffled and grouped by its
whole digest, so the result doesn't depend on the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.scratch import Scratch

#: Filter bits per row, up to MAX_BITS in all (64 MB, the most that is sent to
#: the executors); a table far larger than that fills the filter, and more
#: unique texts take the exact way.
BITS_PER_ROW = 16
MAX_BITS = 1 << 29
_HASHES = 2
_BLOCK = 1 << 16  # bits whose positions travel together


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def filter_bits(rows: int) -> int:
    return min(MAX_BITS, max(_BLOCK, 1 << (rows * BITS_PER_ROW - 1).bit_length()))


def bit_positions(digests: pa.Array, bits: int) -> np.ndarray:
    """(rows, 2) positions from the first 16 bytes of each digest."""
    raw = np.frombuffer(b"".join(d[:16] for d in digests.to_pylist()), dtype="<u8").reshape(-1, _HASHES)
    return (raw & np.uint64(bits - 1)).astype(np.int64)


def _positions(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, count = np.unique(bit_positions(batch.column(0), bits), return_counts=True)
            block, offset = at // _BLOCK, (at % _BLOCK).astype(np.uint16)
            cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            parts = list(zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[cuts].astype(np.int32)),
                    pa.array([offset[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([offset[a:b][count[a:b] > 1].tobytes() for a, b in parts], pa.binary()),
                ],
                names=["block", "once", "twice"],
            )

    return run


def _merge(table: pa.Table) -> pa.Table:
    """The positions of one block that two rows or more have set."""
    count = np.zeros(_BLOCK, dtype=np.int64)
    for once, twice in zip(table.column("once").to_pylist(), table.column("twice").to_pylist()):
        count[np.frombuffer(once, dtype=np.uint16)] += 1
        count[np.frombuffer(twice, dtype=np.uint16)] += 1
    twice = np.flatnonzero(count > 1).astype(np.uint16).tobytes()
    return pa.table({"block": table.column("block")[:1], "twice": pa.array([twice], pa.binary())})


def possibly_repeated(digests: DataFrame, scratch: Scratch) -> DataFrame:
    """``digests`` (doc_id, digest) with a column ``maybe``: false only for
    digests that occur once."""
    spark = digests.sparkSession
    bits = filter_bits(digests.count())
    blocks = digests.select("digest").mapInArrow(_positions(bits), "block int, once binary, twice binary")
    merged = blocks.groupBy("block").applyInArrow(_merge, "block int, twice binary")
    twice = np.zeros(bits // 8, dtype=np.uint8)
    for r in merged.toLocalIterator():  # the filter, at most MAX_BITS
        at = r["block"] * _BLOCK + np.frombuffer(r["twice"], dtype=np.uint16).astype(np.int64)
        np.bitwise_or.at(twice, at >> 3, (1 << (at & 7)).astype(np.uint8))
    sent = spark.sparkContext.broadcast(twice.tobytes())

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.frombuffer(sent.value, dtype=np.uint8)
        for batch in batches:
            at = bit_positions(batch.column(1), bits)
            maybe = (inside[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maybe)], names=["doc_id", "digest", "maybe"])

    return digests.select("doc_id", "digest").mapInArrow(test, "doc_id long, digest binary, maybe boolean")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (smallest doc_id with an
    equal text), group_size, kept (doc_id is keep_id), text_sha256.

    Texts are equal when they are identical after each run of ASCII white space
    is one space; null is empty; whole texts count, of any length. doc_id is
    distinct but for repeated rows, which stay or go together; a null one never is
    a keep_id unless its whole group's are null.
    Other columns are ignored. An empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        digest = F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")
        digests = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest), "digests")
        flagged = scratch.keep(possibly_repeated(digests, scratch), "flagged")
        maybe = flagged.where("maybe").select("doc_id", "digest")
        groups = maybe.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        # a table, not an aggregate: the planner then splits a digest that very many rows hold
        groups = scratch.keep(groups.where("group_size > 1"), "groups")
    grouped = maybe.join(groups, "digest", "left").select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "digest"
    )
    unique = flagged.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    return grouped.unionByName(unique).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
