"""Repeated byte strings of a fixed depth, by a depth-limited radix sort.

A byte goes when a string of ``depth`` bytes that covers it starts anywhere else
too. Sorting a suffix for every byte of a corpus would shuffle many times its
size, so the first, coarsest digit is content-defined: every depth-byte string
has an anchor, the leftmost of its 32-byte grams with the least hash, and equal
strings have equal anchors at the same place. One row per anchor, about one for
170 bytes, is counted; only anchors that occur twice go on, each with the bytes
of the strings it stands for. From there most-significant-digit passes order
the suffixes through ``depth`` bytes, dropping what is alone after each pass;
groups that are left after the last are exactly the repeated strings.

Equal texts are one text with a count, and an anchor of very many documents is
dealt to several tasks, whose distinct strings are then counted together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import chunks, mix, span_hash
from tessera.scratch import Scratch, shuffle_partitions

DEPTH = 400
#: Documents with one anchor that meet in one task.
TASK_DOCS = 4096
#: Bytes that a task sorts at once, unless one anchor has more.
SORT_BYTES = 1 << 20
_GRAM = 32
_DIGIT = 100
_PLACE_BITS = 28  # a batch chunk's bytes; larger texts are cut into pieces of windows
_PIECE = 1 << 24
_U64 = np.uint64


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(buf: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """The windows (starts of depth-byte strings) of all rows of a chunk, in runs
    with one anchor: (row, hash of the anchor's gram, first window, last window)."""
    out: list[tuple[np.ndarray, ...]] = []
    hasher = span_hash(53)
    for low in range(0, max(1, len(buf) - depth + 1), _PIECE):
        part = buf[low : low + _PIECE + depth - 1]
        if len(part) < depth:
            break
        grams = hasher.rolling(hasher.prefix(part), _GRAM)
        place = _U64((1 << _PLACE_BITS) - 1)
        least = _window_least((grams & ~place) | np.arange(len(grams), dtype=np.uint64), depth - _GRAM + 1)
        starts = np.arange(len(least)) + low
        row = np.searchsorted(offs, starts, side="right") - 1
        inside = starts + depth <= offs[row + 1]
        starts, row, anchor = starts[inside], row[inside], (least[inside] & place).astype(np.int64)
        if not len(starts):
            continue
        first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
        last = np.append(first[1:], len(starts)) - 1
        out.append((row[first], grams[anchor[first]], starts[first], starts[last]))
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def repeated_windows(buf: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Which of the depth-byte strings at ``starts`` occur twice within their
    ``group`` (0, 1, ...): radix passes over digits of bytes, most significant
    first; a string that is alone after a pass takes no part in the next."""
    hasher = span_hash(59)
    sums = hasher.prefix(buf)
    at = np.arange(len(starts))
    key = group.astype(np.uint64)
    for low in range(0, depth, _DIGIT):
        size = min(_DIGIT, depth - low)
        here = starts[at] + low
        digit = hasher.spans(sums, here, here + size)
        _, key, count = np.unique(mix(key) ^ digit, return_inverse=True, return_counts=True)
        alive = count[key] > 1
        at, key = at[alive], key[alive].astype(np.uint64)
    out = np.zeros(len(starts), dtype=bool)
    out[at] = True
    return out


# -- jobs ------------------------------------------------------------------------------


def _anchors(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(1)):
                row, gram, _, _ = anchor_runs(buf, offs, depth)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = [np.unique(gram[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(offs)),
                        pa.array([hashlib.sha256(buf[a:b]).digest() for a, b in zip(offs[:-1], offs[1:])], pa.binary()),
                        pa.array([len(x) < n for x, n in zip(lists, np.diff(cuts))], pa.bool_()),
                        pa.array([x.view(np.int64) for x in lists], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_bytes", "digest", "again", "anchors"],
                )

    return run


_RUN = pa.schema([("anchor", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])


def _shared_runs(depth: int):
    """(doc_id, text, shared: anchor and salts) to the runs with those anchors,
    or with an anchor that the document has twice. Runs of the same bytes in one
    document go on once; their spans come out at once, with salts 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = span_hash(61)
        for batch in batches:
            ids = np.asarray(batch.column(0))
            mixed = mix(ids.view(np.uint64))  # ids may share a factor with the number of salts
            shared = batch.column(2).to_pylist()
            for lo, hi, buf, offs in chunks(batch.column(1)):
                row, gram, first, last = anchor_runs(buf, offs, depth)
                content = hasher.spans(hasher.prefix(buf), first, last + depth)
                cuts, raw, rows = np.searchsorted(row, np.arange(hi - lo + 1)), buf.tobytes(), []
                for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    if a == b:
                        continue
                    doc = int(ids[lo + k])
                    known = np.array([s["anchor"] for s in shared[lo + k] or ()], dtype=np.int64).view(np.uint64)
                    salts = np.array([s["salts"] for s in shared[lo + k] or ()], dtype=np.int64)
                    order = np.argsort(known)
                    known, salts = known[order], salts[order]
                    grams = gram[a:b]
                    _, back, times = np.unique(grams, return_inverse=True, return_counts=True)
                    place = np.minimum(np.searchsorted(known, grams), max(0, len(known) - 1))
                    found = known[place] == grams if len(known) else np.zeros(b - a, dtype=bool)
                    _, head, copy, same = np.unique(content[a:b], return_index=True, return_inverse=True, return_counts=True)
                    for i in np.flatnonzero(found | (times[back] > 1)).tolist():
                        s, e = int(first[a + i]), int(last[a + i]) + depth
                        start = s - int(offs[k])
                        if same[copy[i]] > 1:
                            rows.append((0, 0, 0, doc, start, (e - s).to_bytes(8, "big")))
                        if head[copy[i]] == i:
                            n = int(salts[place[i]]) if found[i] else 1
                            rows.append((int(grams[i].view(np.int64)), int(mixed[lo + k] % np.uint64(n)), n, doc, start, raw[s:e]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), _RUN.types)], schema=_RUN)

    return run


_SPAN = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])


def _sort_runs(depth: int):
    """Runs sorted by (anchor, salt) to spans of repeated strings (k1 null), and
    for anchors with several salts to one row per distinct string: its hash and
    its place (doc_id null when its span is out already)."""

    def solve(rows: list[tuple]) -> list[pa.RecordBatch]:
        keys: dict[tuple, int] = {}
        group = np.array([keys.setdefault(r[:2], len(keys)) for r in rows])
        buf = np.frombuffer(b"".join(r[5] for r in rows), dtype=np.uint8)
        size = np.array([len(r[5]) for r in rows], dtype=np.int64)
        base = np.cumsum(size) - size
        windows = size - depth + 1
        owner = np.repeat(np.arange(len(rows)), windows)
        inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = base[owner] + inner
        twice = repeated_windows(buf, starts, group[owner], depth)
        doc = np.array([r[3] for r in rows], dtype=np.int64)
        origin = np.array([r[4] for r in rows], dtype=np.int64)
        edge_in = twice & np.concatenate(([True], (owner[1:] != owner[:-1]) | ~twice[:-1]))
        edge_out = twice & np.concatenate(((owner[1:] != owner[:-1]) | ~twice[1:], [True]))
        a, b = np.flatnonzero(edge_in), np.flatnonzero(edge_out)
        out = [(doc[owner[a]], origin[owner[a]] + inner[a], origin[owner[b]] + inner[b] + depth, None, None)]
        many = np.array([r[2] > 1 for r in rows])
        if many.any():
            w = np.flatnonzero(many[owner])
            k1, k2 = (h.spans(h.prefix(buf), starts[w], starts[w] + depth).view(np.int64) for h in (span_hash(67), span_hash(71)))
            own = mix(k1.view(np.uint64)) ^ k2.view(np.uint64) ^ mix(group[owner[w]].astype(np.uint64))
            _, first = np.unique(own, return_index=True)
            w, k1, k2 = w[first], k1[first], k2[first]
            out.append((pa.array(doc[owner[w]], mask=twice[w]), origin[owner[w]] + inner[w], origin[owner[w]] + inner[w] + depth, k1, k2))
        batches = [pa.RecordBatch.from_arrays([pa.nulls(len(x[0]), pa.int64()) if c is None else pa.array(c) for c in x], schema=_SPAN) for x in out]
        return pa.Table.from_batches(batches).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if size > SORT_BYTES and r[:2] != held[-1][:2]:
                    yield from solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
        if held:
            yield from solve(held)

    return run


def _merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to merged spans and the digest of what they leave."""
    for batch in batches:
        for lo, hi, buf, offs in chunks(batch.column(1)):
            lists, digests = [], []
            for k, spans in enumerate(batch.column(2).slice(lo, hi - lo).to_pylist()):
                own = buf[offs[k] : offs[k + 1]]
                a, b = _merge_spans(*(np.array([s[c] for s in spans], dtype=np.int64) for c in ("start", "end")))
                lists.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
                digest, at = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), b.tolist()):
                    digest.update(own[at:x])
                    at = y
                digest.update(own[at:])
                digests.append(digest.digest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(lists, kind), pa.array(digests, pa.binary())], names=["doc_id", "spans", "digest"]
            )


def repeated_spans(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans
    (maximal runs of bytes to remove: start, end), kept_sha256 (of the remaining
    bytes concatenated, lower-case hex).

    Texts are whole UTF-8 byte strings, null is empty, strings never cross texts,
    and all strings are judged on the input. A text shorter than ``depth`` loses
    nothing; equal texts of at least that length lose everything. doc_id is
    distinct but for repeated rows, which are equal texts; a row without one is
    compared as a whole text only. Other columns are ignored; an empty table
    gives an empty result. ``depth`` is at least 64.
    """
    if depth < 2 * _GRAM:
        raise ValueError(f"depth must be at least {2 * _GRAM}")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    partitions = shuffle_partitions(source, 8 << 20)
    with Scratch(docs.sparkSession) as scratch:
        infos = source.mapInArrow(_anchors(depth), "doc_id long, n_bytes long, digest binary, again boolean, anchors array<long>")
        infos = scratch.table(infos, "anchors")
        copies = infos.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
        copies = scratch.table(copies, "copies")
        reps = infos.join(copies.select("rep", "copies"), infos["doc_id"] == F.col("rep")).select("doc_id", "copies", "again", "anchors")
        reps = reps.where(F.size("anchors") > 0)

        # anchors of two texts or more, with the number of tasks each is dealt to
        owned = reps.select("doc_id", F.explode("anchors").alias("anchor"))
        salts = F.ceil(F.col("docs") / TASK_DOCS).cast("int").alias("salts")
        often = owned.groupBy("anchor").agg(F.count("*").alias("docs")).where("docs > 1").select("anchor", salts)
        often = scratch.table(often, "often")  # written, so that the planner can split an anchor of very many texts
        shared = owned.join(often, "anchor").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "salts")).alias("shared"))
        alone = reps.where("again").select("doc_id", F.array().cast("array<struct<anchor:bigint,salts:int>>").alias("shared"))
        wanted = shared.unionByName(alone).groupBy("doc_id").agg(F.flatten(F.collect_list("shared")).alias("shared"))
        texts = scratch.table(source.join(wanted, "doc_id").select("doc_id", "text", "shared"), "candidates")

        runs = texts.mapInArrow(_shared_runs(depth), "anchor long, salt int, salts int, doc_id long, start long, bytes binary")
        runs = scratch.table(runs, "runs")
        inner = runs.where("salts = 0").select("doc_id", "start", (F.col("start") + F.conv(F.hex("bytes"), 16, 10).cast("long")).alias("end"))
        sorted_runs = runs.where("salts > 0").repartition(partitions, "anchor", "salt").sortWithinPartitions("anchor", "salt")
        spans = scratch.table(sorted_runs.mapInArrow(_sort_runs(depth), "doc_id long, start long, end long, k1 long, k2 long"), "spans")
        keyed = spans.where("k1 is not null")
        twice = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
        across = keyed.where("doc_id is not null").join(twice, ["k1", "k2"]).select("doc_id", "start", "end")
        spans = spans.where("k1 is null").select("doc_id", "start", "end").unionByName(inner).unionByName(across)
        found = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        # a text with copies goes whole; the others keep what is outside the spans
        whole = copies.where("copies > 1").select("digest", F.lit(True).alias("whole"))
        single = found.join(copies.where("copies > 1").select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
        cut = texts.select("doc_id", "text").join(single, "doc_id").select("doc_id", "text", "spans")
        cut = cut.mapInArrow(_cut, "doc_id long, spans array<struct<start:long,end:long>>, digest binary")
        cut = scratch.table(cut.select("doc_id", F.col("spans").alias("cut"), F.col("digest").alias("rest")), "cut")
        gone = F.col("whole").isNotNull() & (F.col("n_bytes") >= depth)
        everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
        none = F.array().cast("array<struct<start:bigint,end:bigint>>")
        result = (
            infos.select("doc_id", "n_bytes", "digest")
            .join(whole, "digest", "left")
            .join(cut, "doc_id", "left")
            .select(
                "doc_id",
                "n_bytes",
                F.when(gone, everything).otherwise(F.coalesce("cut", none)).alias("spans"),
                F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.lower(F.hex(F.coalesce("rest", "digest")))).alias("kept_sha256"),
            )
        )
        result = scratch.keep(result, "suffix-dedup")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return result.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "spans", "kept_sha256")
