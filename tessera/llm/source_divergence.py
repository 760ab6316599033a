"""Divergence of sources by single-pass in-memory indexing.

Every task builds a block of postings, (term, group) to occurrences and
documents, in memory; when the block is full it is spilled as a run that is
sorted by the hash of (term, group) and cut into hash shards. A shard's runs
meet in one task, which merges them through a heap of their next keys into the
frequencies. A term in every document and a source with a third of all rows
are one posting per run each, and the hash takes in the group, so neither makes
a shard large.

The divergence of two sources is a sum over all kept terms, of which a group
holds few. It is the value for a term that neither holds, times the number of
terms, corrected for terms that one of them holds (from counts of equal
probabilities) and for terms that both hold (streamed from the postings).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._text import LOWER, chunks, mix, span_hash, words
from tessera.scratch import Scratch, shuffle_partitions

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Bytes of postings in memory before a block is spilled as a run.
BLOCK_BYTES = 48 << 20
#: Input bytes to a hash shard.
SHARD_BYTES = 32 << 20
#: Rows that a merge takes from a run at a time; pairs that a correction makes at a time.
MERGE_ROWS = 1 << 14
PAIRS_AT_ONCE = 1 << 20
#: Sums of source pairs that a task holds before it passes them on.
MAX_SUMS = 1 << 18

#: Bytes of terms: letters, and all bytes of other characters.
TERM = np.zeros(256, dtype=bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Postings:
    """Sorted by key, the hash of term and group; parallel arrays."""

    keys: np.ndarray
    groups: np.ndarray
    terms: pa.StringArray
    n: np.ndarray
    docs: np.ndarray

    def __len__(self) -> int:
        return len(self.keys)

    @property
    def bytes(self) -> int:
        return 32 * len(self) + self.terms.nbytes

    def slice(self, a: int, b: int) -> Postings:
        return Postings(self.keys[a:b], self.groups[a:b], self.terms[a:b], self.n[a:b], self.docs[a:b])


def combined(parts: list[Postings]) -> Postings:
    """One posting per (term, group), sorted by key; equal keys of different
    terms or groups stay apart."""
    keys, groups, n, docs = (np.concatenate([getattr(p, c) for p in parts]) for c in ("keys", "groups", "n", "docs"))
    terms = pa.concat_arrays([p.terms for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, groups, terms = keys[order], groups[order], terms.take(pa.array(order))
    same = keys[1:] == keys[:-1]
    equal = np.asarray(pc.equal(terms[1:], terms[:-1])) & (groups[1:] == groups[:-1])
    if (same & ~equal).any():  # a clash of hashes
        codes = np.asarray(terms.dictionary_encode().indices)
        again = np.lexsort((codes, groups, keys))
        order, keys, groups, codes = order[again], keys[again], groups[again], codes[again]
        terms = terms.take(pa.array(again))
        same = keys[1:] == keys[:-1]
        equal = (codes[1:] == codes[:-1]) & (groups[1:] == groups[:-1])
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), ~(same & equal))))
    if not len(first):
        return Postings(keys, groups, terms, n, docs)
    return Postings(keys[first], groups[first], terms.take(pa.array(first)), np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first))


class Groups:
    """Numbers and hashes of (lang, source) as a task meets them."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}
        self.names: list[tuple[str, str]] = []
        self.hashes = np.zeros(0, dtype=np.uint64)

    def of(self, names: list[tuple[str, str]]) -> np.ndarray:
        for x in dict.fromkeys(names):
            if x not in self.number:
                self.number[x] = len(self.names)
                self.names.append(x)
                digest = blake2b(f"{len(x[0])} {x[0]}{x[1]}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
                self.hashes = np.append(self.hashes, np.frombuffer(digest, dtype="<u8"))
        return np.array([self.number[x] for x in names], dtype=np.int32)


def chunk_postings(buf: np.ndarray, offs: np.ndarray, group: np.ndarray, hashes: np.ndarray) -> Postings:
    """Postings of a chunk of texts, of which ``group`` numbers the groups."""
    low = LOWER[buf]
    starts, ends, first = words(low, offs, TERM)
    hasher = span_hash(131)
    kinds, at, kind = np.unique(hasher.spans(hasher.prefix(low), starts, ends), return_index=True, return_inverse=True)
    width = max(1, len(kinds))
    row = np.repeat(np.arange(len(group), dtype=np.int64), np.diff(first))
    in_row, times = np.unique(row * width + kind, return_counts=True)  # of a document's terms
    cell = group[in_row // width].astype(np.int64) * width + in_row % width
    order = np.argsort(cell, kind="stable")
    cells, begin = np.unique(cell[order], return_index=True)
    if not len(cells):
        return Postings(*(np.zeros(0, dtype=t) for t in (np.uint64, np.int32)), pa.array([], pa.string()), *(np.zeros(0, dtype=np.int64),) * 2)
    n = np.add.reduceat(times[order], begin).astype(np.int64)
    docs = np.diff(np.append(begin, len(cell))).astype(np.int64)
    kind, group = cells % width, (cells // width).astype(np.int32)
    a, size = starts[at[kind]], (ends - starts)[at[kind]]
    cuts = np.concatenate(([0], np.cumsum(size)))
    data = low[np.repeat(a - cuts[:-1], size) + np.arange(cuts[-1])]
    terms = pa.StringArray.from_buffers(len(kind), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data.tobytes()))
    return combined([Postings(mix(kinds[kind] ^ hashes[group]), group, terms, n, docs)])


RUN_DDL = "shard int, run long, langs array<string>, sources array<string>, keys binary, groups binary, terms array<string>, n binary, docs binary"
_RUN = pa.schema(
    [("shard", pa.int32()), ("run", pa.int64()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string()))]
    + [("keys", pa.binary()), ("groups", pa.binary()), ("terms", pa.list_(pa.string())), ("n", pa.binary()), ("docs", pa.binary())]
)


def _segments(block: Postings, groups: Groups, shards: int, run: int) -> Iterator[pa.RecordBatch]:
    """A run, a row to a shard; shards are ranges of the key, so each segment is sorted."""
    shard = ((block.keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)
    cuts = np.flatnonzero(np.concatenate((np.ones(min(1, len(shard)), dtype=bool), shard[1:] != shard[:-1]))).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(shard)]):
        part = block.slice(a, b)
        used, local = np.unique(part.groups, return_inverse=True)
        names = [groups.names[g] for g in used.tolist()]
        row = {
            "shard": int(shard[a]), "run": run, "langs": [x[0] for x in names], "sources": [x[1] for x in names],
            "keys": part.keys.astype("<u8").tobytes(), "groups": local.astype("<i4").tobytes(),
            "n": part.n.astype("<i8").tobytes(), "docs": part.docs.astype("<i8").tobytes(),
        }
        terms = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.terms)
        columns = [terms if f.name == "terms" else pa.array([row[f.name]], f.type) for f in _RUN]
        yield pa.RecordBatch.from_arrays(columns, schema=_RUN)


def _spill_runs(shards: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, size = Groups(), [], 0
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            group = groups.of(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
            for lo, hi, buf, offs in chunks(batch.column(2)):
                part = chunk_postings(buf, offs, group[lo:hi], groups.hashes)
                held.append(part)
                size += part.bytes
                if size > block_bytes:
                    held = [combined(held)]
                    size = held[0].bytes
                    if size > block_bytes // 2:
                        yield from _segments(held[0], groups, shards, number)
                        held, size, number = [], 0, number + 1
        if held:
            yield from _segments(combined(held), groups, shards, number)

    return run


FREQUENCY_DDL = "lang string, source string, term string, n long, docs long"


def merged_runs(runs: list[Postings], rows: int = MERGE_ROWS) -> Iterator[Postings]:
    """The runs in key order, equal postings summed: a heap holds the next key
    of every run, and what all runs have up to the end of the first one's next
    ``rows`` rows is combined and passed on."""
    heap = [(int(r.keys[0]), k, 0) for k, r in enumerate(runs) if len(r)]
    heapq.heapify(heap)
    while heap:
        _, k, at = heap[0]
        last = runs[k].keys[min(at + rows, len(runs[k])) - 1]
        parts = []
        while heap and heap[0][0] <= int(last):
            _, k, at = heapq.heappop(heap)
            end = int(np.searchsorted(runs[k].keys, last, side="right"))
            parts.append(runs[k].slice(at, end))
            if end < len(runs[k]):
                heapq.heappush(heap, (int(runs[k].keys[end]), k, end))
        yield combined(parts)


def _merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by shard; one shard's runs are held at a time."""
    shard, groups, held = None, Groups(), []

    def merge() -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([x[i] for x in groups.names], pa.string()) for i in (0, 1))
        for part in merged_runs(held):
            at = pa.array(part.groups)
            yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), part.terms, pa.array(part.n), pa.array(part.docs)], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for i in range(batch.num_rows):
            row = {f.name: batch.column(j)[i] for j, f in enumerate(batch.schema)}
            if row["shard"].as_py() != shard:
                yield from merge()
                shard, groups, held = row["shard"].as_py(), Groups(), []
            number = groups.of(list(zip(row["langs"].as_py(), row["sources"].as_py())))
            keys, local, n, docs = (np.frombuffer(row[c].as_py(), dtype=t) for c, t in (("keys", "<u8"), ("groups", "<i4"), ("n", "<i8"), ("docs", "<i8")))
            held.append(Postings(keys, number[local], pa.concat_arrays([row["terms"].values]), n, docs))
    yield from merge()


def term_frequencies(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in
    every group; ``docs`` (lang, source, text) has no nulls."""
    shards = shuffle_partitions(docs, SHARD_BYTES)
    runs = docs.select("lang", "source", "text").mapInArrow(_spill_runs(shards, block_bytes), RUN_DDL)
    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "run")
    return scratch.table(dealt.mapInArrow(_merge_shards, FREQUENCY_DDL), "frequencies")


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), by long division in steps of
    1000, so exact in 64 bits for totals below 9e15."""
    whole = total + terms
    digits, rest = _div(n + 1, whole), (n + 1) % whole
    for _ in range(3):
        digits, rest = digits * 1000 + _div(rest * 1000, whole), (rest * 1000) % whole
    return digits + 1


def _div(a: Column, b: Column) -> Column:
    """Whole part of a quotient of longs that aren't negative."""
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


PAIR_DDL = "lang string, source string, item string, value long"


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _common_term_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For terms of several sources of a language, what each ordered pair of
    them adds beyond the corrections for either; summed in the task."""
    sums: dict[tuple[str, str, str], int] = {}

    def passed_on() -> pa.RecordBatch:
        rows = [(*k, v) for k, v in sums.items() if v]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, (pa.string(),) * 3 + (pa.int64(),))], names=["lang", "source", "item", "value"])

    for batch in batches:
        lists = {c: batch.column(batch.schema.get_field_index(c)) for c in ("sources", "p", "base")}
        size = np.asarray(pc.list_value_length(lists["sources"])).astype(np.int64)
        if not size.sum():
            continue
        langs = batch.column(0).dictionary_encode()
        names = lists["sources"].flatten().dictionary_encode()
        sources = np.asarray(names.indices).astype(np.int64)
        p, base = np.asarray(lists["p"].flatten()), np.asarray(lists["base"].flatten())
        lang = np.repeat(np.asarray(langs.indices).astype(np.int64), size)
        begin = np.repeat(np.cumsum(size) - size, size)
        partners = np.repeat(size, size)
        lang_names, source_names = langs.dictionary.to_pylist(), names.dictionary.to_pylist()
        up_to, a = np.cumsum(partners), 0
        while a < len(p):
            b = max(a + 1, int(np.searchsorted(up_to, (up_to[a - 1] if a else 0) + PAIRS_AT_ONCE, side="right")))
            k = partners[a:b]
            left = np.repeat(np.arange(a, b), k)
            right = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(begin[a:b], k)
            left, right = left[left != right], right[left != right]
            value = _divergence(p[left], p[right]) - _divergence(p[left], base[right]) - _divergence(base[left], p[right]) + _divergence(base[left], base[right])
            code = (lang[left] * len(source_names) + sources[left]) * len(source_names) + sources[right]
            order = np.argsort(code, kind="stable")
            codes, first = np.unique(code[order], return_index=True)
            if len(codes):
                for c, v in zip(codes.tolist(), np.add.reduceat(value[order], first).tolist()):
                    rest, t = divmod(c, len(source_names))
                    x, s = divmod(rest, len(source_names))
                    key = (lang_names[x], source_names[s], source_names[t])
                    sums[key] = sums.get(key, 0) + v
            if len(sums) > MAX_SUMS:
                yield passed_on()
            a = b
    yield passed_on()


def _exact(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """How the sources of each language differ in their words.

    ``docs`` has text, lang and source; nulls are empty strings, so rows without
    a language or source are a group of that name. A language keeps the terms of
    at least ``min_docs`` of its rows; a repeated row counts again. Result: lang,
    source, part, item, value, rank. Part ``pair`` has a row for each other source
    (item) of the language, also where neither has a kept term (value 0); part
    ``term`` has the ``top_terms`` kept terms that the source uses more than its
    language does. All sums are exact. Ranks go by value, of equal ones by item.
    A table of one source has no ``pair`` rows, an empty table an empty result;
    other columns are ignored. A task holds one text, ``block_bytes`` of postings
    and one shard of runs.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    with Scratch(docs.sparkSession) as scratch:
        found = term_frequencies(docs, scratch, block_bytes)
        index = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("postings"))
        index = scratch.table(index.where(F.col("docs") >= min_docs).drop("docs"), "index")
        flat = index.select("lang", "term", "lang_n", F.inline("postings"))
        langs = index.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
        totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.na.fill(0, ["total", "terms", "lang_total"])
        base = F.when(F.col("terms") > 0, probability(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
        groups = scratch.table(groups.withColumn("base", base), "groups")
        weighed = flat.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms")))
        weighed = scratch.table(weighed.withColumn("q", probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))), "weighed")

        terms = weighed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        terms = _ranked(terms).where(F.col("rank") <= top_terms)

        other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
        p, b, q = F.col("p"), F.col("base"), F.col("item_base")
        neither = groups.join(other, "lang").where("source <> item").select("lang", "source", "item", (_exact(F.coalesce(divergence(b, q), F.lit(0))) * _exact(F.col("terms"))).alias("value"))
        equal = weighed.groupBy("lang", "source", "base", "p").agg(F.count("*").alias("times"))
        either = equal.join(other, "lang").where("source <> item")
        own = either.select("lang", "source", "item", (_exact(divergence(p, q) - divergence(b, q)) * _exact(F.col("times"))).alias("value"))
        its = either.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (_exact(divergence(q, p) - divergence(q, b)) * _exact(F.col("times"))).alias("value"))
        lists = weighed.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("x")).where(F.size("x") > 1)
        lists = lists.select("lang", F.col("x.source").alias("sources"), F.col("x.p").alias("p"), F.col("x.base").alias("base"))
        both = lists.mapInArrow(_common_term_corrections, PAIR_DDL).select("lang", "source", "item", _exact(F.col("value")).alias("value"))
        pairs = reduce(DataFrame.unionByName, [neither, own, its, both]).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
        pairs = _ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
        return scratch.keep(pairs.unionByName(terms), "divergence")
