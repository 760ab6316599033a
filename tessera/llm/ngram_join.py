"""N-gram Jaccard join with signature trees.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches a threshold. The join is exact:

1. *Screen.* A document that links must have nearly all its shingles in common
   with one other. The shingles of a fixed part of the hash range are counted,
   and documents with more of them to themselves than a link allows are out.
   Each input batch sends a shingle once, so one that a third of all documents
   share is combined before the shuffle.
2. *Candidates.* The sets left are cut by hash range into parts, more of them
   non-empty than two linked sets can differ in elements, so two linked sets
   agree on at least one whole part (pigeonhole). Equal parts are joined as stars.
3. *Families.* Connected components of these stars hold every linked pair.
   One passage in very many texts makes one family of them, so a family of
   very many blocks is cut again: its shingles are ordered by how many of its sets
   hold them, and a set stars with those that share one of its rarest, one more
   of them than a linked set may lack.
4. *Signature trees.* Inside a family (cut into blocks of bounded size, every
   pair of blocks one task) sets become token bitmaps under a tree whose nodes
   hold the OR of their bitmaps and their size range. Two trees are traversed
   together, and a pair of nodes is dropped when its largest possible overlap,
   or its size ranges, can't reach the threshold.
5. *Components* of the links found, over one representative per distinct set.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import chunks, mix, shingle_sets
from tessera.llm.components import connected_components
from tessera.scratch import Scratch, shuffle_partitions

#: Largest number of sets, and of their shingles, in one block of a family
#: (a single larger set is a block of its own).
BLOCK_SETS = 1024
BLOCK_SHINGLES = 1 << 20
#: A family of more blocks than this is cut: that ships some 33 bytes a shingle,
#: and as many blocks 8 bytes each. Shingles that one task counts for it.
CUT_BLOCKS = 4
TASK_SHINGLES = 1 << 20
FANOUT = 8
#: Widest token bitmap of a tree, in bits.
MAX_BITS = 1 << 14
#: Bytes of bitmaps that are compared at once.
PAIR_BYTES = 8 << 20
_RESEED = 3
_U64 = np.uint64


class Threshold:
    """Similarity of at least ``percent`` / 100, in whole numbers."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be from 50 to 100")
        self.percent = percent

    def least_partner(self, n: int) -> int:
        return -(-n * self.percent // 100)

    def largest_partner(self, n: int) -> int:
        return n * 100 // self.percent

    def least_overlap(self, total):
        """Smallest intersection of two linked sets with ``total`` elements together."""
        return -(-total * self.percent // (100 + self.percent))

    def most_alone(self, n: int) -> int:
        """Most elements of a set of ``n`` that a linked one lacks."""
        return n - self.least_partner(n)

    def screened(self) -> int:
        """Hashes below this are counted by the screen: two and a half times the
        share of a set that a linked one may lack."""
        return min(2**64 - 1, (100 - self.percent) * 5 * 2**64 // 200)

    def most_difference(self, n: int) -> int:
        """Most elements in which a set of ``n`` and a larger linked one differ."""
        total = n + self.largest_partner(n)
        return total * (100 - self.percent) // (100 + self.percent)


@lru_cache(maxsize=None)
def _classes() -> tuple[int, ...]:
    """First sizes of the size classes. Narrow classes: a pair's parts are as few,
    and so as large and telling, as the smaller set's class allows."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * 11 // 10))
    return tuple(starts)


def _class_of(n: int) -> int:
    return bisect_right(_classes(), n) - 1


@lru_cache(maxsize=None)
def _parts(percent: int, klass: int) -> tuple[np.ndarray, int]:
    """(first hash of every part but the first, most differing elements) for
    pairs whose smaller set is in size class ``klass``."""
    starts = _classes()
    low, differ = starts[klass], Threshold(percent).most_difference(starts[klass + 1] - 1)
    parts = differ + 1
    if differ:  # enough parts that a set has more than `differ` non-empty ones, three deviations out
        while True:
            full = parts * (1 - exp(-low / parts))
            if full - 3 * sqrt(full * exp(-low / parts)) >= differ + 1 or parts > 4 * low:
                break
            parts += max(1, parts // 50)
    return np.array([-(-(p << 64) // parts) for p in range(1, parts)], dtype=np.uint64), differ


def part_signatures(values: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one sorted set such that any two linked sets share one.

    A pair is cut as the class of its smaller set says, so a set signs for its
    own class and for those of the smaller sets it may link to. Two linked sets agree on all but ``differ`` parts; a set with more non-empty
    parts than that therefore shares a non-empty one with each partner. A set
    with too few also signs a cut by another hash, where its partner, in the
    same case, does too, and in the end a signature common to its size class.
    """
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    out = []
    for tag in range(_class_of(Threshold(percent).least_partner(n)), _class_of(n) + 1):
        edges, differ = _parts(percent, tag)
        for seed in range(_RESEED + 1):
            keys = values if not seed else np.sort(mix(values + _U64(seed * 0x9E37)))
            cuts = np.concatenate(([0], np.searchsorted(keys, edges), [n]))
            sums = np.concatenate((np.zeros(1, _U64), np.cumsum(mix(keys ^ _U64(0x5BD1E995)), dtype=np.uint64)))
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            label = _U64((tag << 40) + (seed << 36)) + full.astype(np.uint64)
            out.append(mix(sums[cuts[full + 1]] - sums[cuts[full]] + mix(label)))
            if len(full) > differ:
                break
        else:
            out.append(mix(np.array([(tag << 40) + (15 << 36)], dtype=np.uint64)))
    return np.concatenate(out)


# -- steps 1 and 2: screen, signatures and stars of equal parts ------------------

# rows that carry many entries: (partition to go to, kind, numbers, numbers)
_PACKED_DDL = "bucket int, kind int, a binary, b binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_SET, _COUNT, _ENTRY, _SHARED = 0, 1, 2, 3


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of documents: by a hash, as ids may share a factor with their number."""
    return (mix(ids.view(np.uint64)) % _U64(buckets)).astype(np.int64)


def _deal(kind: int, bucket: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple]:
    """Rows of the entries (a, b), one for each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    bucket, a, b = bucket[order], a[order], b[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, dtype=np.int64)
    return [(int(bucket[x]), kind, a[x:y].tobytes(), b[x:y].tobytes()) for x, y in zip(cuts.tolist(), np.append(cuts[1:], len(bucket)).tolist())]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), _PACKED.types)], schema=_PACKED)


def _unpack(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    out: dict[int, list] = {_SET: [], _COUNT: [], _ENTRY: [], _SHARED: []}
    for batch in batches:
        for kind, a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            out[kind].append((np.frombuffer(a, dtype=np.int64), np.frombuffer(b, dtype=np.int64)))
    return out


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each run of equal sorted keys, run of each key)."""
    head = np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1]))
    return np.flatnonzero(head), np.cumsum(head) - 1


def _screen_batch(size: int, limit: Threshold, buckets: int):
    """Each document's set in brief, with the number of its counted shingles that
    no other document of the batch has; each counted shingle of the batch, with
    the document that alone has it there, or as shared."""
    bound = _U64(limit.screened())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0))
            brief, tokens = np.zeros((batch.num_rows, 4), dtype=np.int64), []
            for lo, hi, buf, offs in chunks(batch.column(1)):
                for k, values in enumerate(shingle_sets(buf, offs, size), lo):
                    h1 = mix(values).sum(dtype=np.uint64)
                    h2 = mix(values ^ _U64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
                    tokens.append(values[: np.searchsorted(values, bound)])
                    brief[k] = len(values), h1.astype(np.int64), h2.astype(np.int64), len(tokens[-1])
            rows = np.repeat(np.arange(len(tokens)), brief[:, 3])
            token = np.concatenate(tokens)
            order = np.argsort(token, kind="stable")
            token, rows = token[order], rows[order]
            first, run_of = _runs(token)
            single = np.diff(np.append(first, len(token))) == 1
            shared = ~single[run_of] if len(token) else np.zeros(0, dtype=bool)
            brief[:, 3] -= np.bincount(rows[shared], minlength=len(brief))
            out, token, rows = [], token[first], rows[first]
            for kind, own in ((_ENTRY, single), (_SHARED, ~single)):
                mine = token[own]
                out += _deal(kind, (mine % _U64(buckets)).astype(np.int64), mine.view(np.int64), ids[rows[own]])
            yield _packed(out + _deal(_SET, _bucket(ids, buckets), ids, brief.view([("", np.int64)] * 4).ravel()))

    return run


def _count_shared(buckets: int):
    """Of the entries of a bucket's shingles: how many shared ones each document
    has, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _unpack(batches)
        entries = parts.pop(_ENTRY) + parts[_SHARED]
        if entries:
            known = sum(len(x) for x, _ in parts[_SHARED])  # these come last, and are counted already
            token, owner = (np.concatenate(x) for x in zip(*entries))
            alone = np.arange(len(token)) < len(token) - known
            order = np.argsort(token, kind="stable")
            token, owner, alone = token[order], owner[order], alone[order]
            first, run_of = _runs(token)
            shared = np.diff(np.append(first, len(token)))[run_of] > 1
            docs, counts = np.unique(owner[shared & alone], return_counts=True)
            if len(docs):
                yield _packed(_deal(_COUNT, _bucket(docs, buckets), docs, counts))
        for ids, brief in parts[_SET]:
            yield _packed([(int(_bucket(ids[:1], buckets)[0]), _SET, ids.tobytes(), brief.tobytes())])

    return run


_BRIEF_DDL = "doc_id long, n long, h1 long, h2 long, active boolean"


def _decide(limit: Threshold):
    """Each document's set in brief, and whether it may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _unpack(batches)
        if not parts[_SET]:
            return
        ids = np.concatenate([x for x, _ in parts[_SET]])
        n, h1, h2, alone = np.concatenate([x for _, x in parts[_SET]]).reshape(-1, 4).T.copy()
        order = np.argsort(ids, kind="stable")
        for docs, counts in parts[_COUNT]:
            np.subtract.at(alone, order[np.searchsorted(ids, docs, sorter=order)], counts)
        active = (n > 0) & (alone <= limit.most_alone(n))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, n, h1, h2, active)], names=["doc_id", "n", "h1", "h2", "active"])

    return run


def _stars(signatures: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct signatures, smallest document of each, edges (document, smallest))."""
    order = np.lexsort((docs, signatures))
    signatures, docs = signatures[order], docs[order]
    first, run_of = _runs(signatures)
    least = docs[first][run_of] if len(docs) else docs
    edges = np.unique(np.stack((docs, least), axis=1)[docs != least], axis=0).reshape(-1, 2)
    return signatures[first], docs[first], edges


def _sign(size: int, percent: int, buckets: int):
    """Part signatures of a batch, each with the smallest document that has it,
    and the edges of the batch's own stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, signatures = np.asarray(batch.column(0)), []
            for _, _, buf, offs in chunks(batch.column(1)):
                signatures += [part_signatures(values, percent) for values in shingle_sets(buf, offs, size)]
            signed, docs, edges = _stars(np.concatenate(signatures), np.repeat(ids, [len(x) for x in signatures]))
            rows = _deal(_ENTRY, (signed % _U64(buckets)).astype(np.int64), signed.view(np.int64), docs)
            yield _packed(rows + _deal(_SET, _bucket(edges[:, 0].copy(), buckets), *edges.T.copy()))

    return run


def _link_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = _unpack(batches)
    found = [np.stack(x, axis=1) for x in parts[_SET]]
    if parts[_ENTRY]:
        signatures, docs = (np.concatenate(x) for x in zip(*parts[_ENTRY]))
        found.append(_stars(signatures, docs)[2])
    if found:
        u, v = np.concatenate(found).T.copy()
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


# -- step 3: large families by their rarest shingles ------------------------------


def _key_batch(size: int, buckets: int):
    """Rows (family, document, text) to every shingle, as a key of its family's, with
    its document, and each document's number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            family, ids = (np.asarray(batch.column(i)) for i in (0, 1))
            sets = [values for _, _, buf, offs in chunks(batch.column(2)) for values in shingle_sets(buf, offs, size)]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            keys = mix(np.concatenate(sets) ^ np.repeat(mix(family.view(np.uint64)), n))
            rows = _deal(_ENTRY, (keys % _U64(buckets)).astype(np.int64), keys.view(np.int64), np.repeat(ids, n))
            yield _packed(rows + _deal(_SET, _bucket(ids, buckets), ids, n))

    return run


def _count_keys(buckets: int):
    """Of the entries of a bucket's keys: those that several documents hold, with
    their number, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _unpack(batches)
        if parts[_ENTRY]:
            keys, docs = (np.concatenate(x) for x in zip(*parts.pop(_ENTRY)))
            order = np.argsort(keys, kind="stable")
            keys, docs = keys[order], docs[order]
            first, run_of = _runs(keys)
            counts = np.diff(np.append(first, len(keys)))[run_of]
            keys, docs, counts = (x[counts > 1] for x in (keys, docs, counts))
            if len(keys):
                yield _packed(_deal(_COUNT, _bucket(docs, buckets), docs, np.stack((keys, counts), axis=1).view([("", np.int64)] * 2).ravel()))
        for ids, n in parts[_SET]:
            yield _packed([(int(_bucket(ids[:1], buckets)[0]), _SET, ids.tobytes(), n.tobytes())])

    return run


def _rarest_keys(limit: Threshold, buckets: int):
    """Of each document's keys the rarest, one more than a linked set may lack: of
    what two linked sets share, the rarest is among these in both. As for
    :func:`_sign`, each with the smallest document, and the edges found here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _unpack(batches)
        if not parts[_COUNT]:
            return
        ids, n = (np.concatenate(x) for x in zip(*parts.pop(_SET)))
        ids, once = np.unique(ids, return_index=True)  # repeated rows
        docs, counted = (np.concatenate(x) for x in zip(*parts.pop(_COUNT)))
        keys, counts = counted.reshape(-1, 2).T.copy()
        order = np.lexsort((keys, counts, docs))
        keys, docs = keys[order], docs[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])))
        keys, docs = keys[new], docs[new]
        first, run_of = _runs(docs)
        n, shared = n[once][np.searchsorted(ids, docs[first])], np.diff(np.append(first, len(docs)))
        kept = limit.most_alone(n) + 1 - (n - shared)  # those of one document alone are the rarest
        kept = np.arange(len(docs)) - first[run_of] < kept[run_of]
        signed, docs, edges = _stars(keys[kept].view(np.uint64), docs[kept])
        rows = _deal(_ENTRY, (signed % _U64(buckets)).astype(np.int64), signed.view(np.int64), docs)
        if rows:
            yield _packed(rows + _deal(_SET, _bucket(edges[:, 0].copy(), buckets), *edges.T.copy()))

    return run


def _with_blocks(members: DataFrame) -> DataFrame:
    """Members (rep, weight, n, family) with the number of their family's blocks."""
    totals = members.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    return members.join(totals.select("family", blocks.alias("blocks")), "family").select("family", "rep", "weight", "n", "blocks")


def _cut_families(members: DataFrame, texts: DataFrame, size: int, limit: Threshold, buckets: int, scratch: Scratch) -> DataFrame:
    """``members`` with families of very many blocks cut by their rarest shingles;
    a member that then shares none of these links with nothing and goes."""
    large = members.where(F.col("blocks") > CUT_BLOCKS)
    shingles = large.agg(F.sum("n")).first()[0]
    if shingles is None:
        return members
    buckets = max(buckets, -(-shingles // TASK_SHINGLES))
    named = large.select("family", F.col("rep").alias("doc_id")).hint("merge")
    keys = texts.join(named, "doc_id").select("family", "doc_id", "text").mapInArrow(_key_batch(size, buckets), _PACKED_DDL)
    counted = keys.repartition(buckets, "bucket").mapInArrow(_count_keys(buckets), _PACKED_DDL)
    rarest = counted.repartition(buckets, "bucket").mapInArrow(_rarest_keys(limit, buckets), _PACKED_DDL)
    stars = rarest.repartition(buckets, "bucket").mapInArrow(_link_parts, "u long, v long")
    finer = connected_components(stars, scratch)
    cut = large.join(finer, large["rep"] == finer["node"]).select("rep", "weight", "n", F.col("component").alias("family"))
    return scratch.table(members.where(F.col("blocks") <= CUT_BLOCKS).unionByName(_with_blocks(cut)), "members")


# -- step 4: signature trees ---------------------------------------------------


class SignatureTree:
    """Bitmaps (rows of 64-bit words) of sets, near ones side by side, and per level the
    OR of each :data:`FANOUT` nodes with their sizes' range and largest slack
    (elements of a set that share a bit with another of its elements)."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, slack: np.ndarray):
        self.levels = [(bitmaps, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))


def _possible(a: SignatureTree, b: SignatureTree, level: int, i: np.ndarray, j: np.ndarray, limit: Threshold) -> np.ndarray:
    """Which node pairs may hold linked sets."""
    bits_a, low_a, high_a, slack_a = a.levels[level]
    bits_b, low_b, high_b, slack_b = b.levels[level]
    out = (high_a[i] * 100 >= low_b[j] * limit.percent) & (high_b[j] * 100 >= low_a[i] * limit.percent)
    at = np.flatnonzero(out)
    common = np.bitwise_count(bits_a[i[at]] & bits_b[j[at]]).sum(axis=1, dtype=np.int64)
    most = common + np.minimum(slack_a[i[at]], slack_b[j[at]])
    out[at] = most >= limit.least_overlap(low_a[i[at]] + low_b[j[at]])
    return out


def dual_traversal(a: SignatureTree, b: SignatureTree, limit: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of sets of the two trees that pass every bound; with the
    same tree twice, each pair once and no set with itself."""
    top = max(len(a.levels), len(b.levels)) - 1
    for tree in (a, b):
        while len(tree.levels) <= top:
            tree.levels.append(tree.levels[-1])
    step_pairs = max(256, PAIR_BYTES // max(8, a.levels[0][0].shape[1] * 8))
    stack = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        level, i, j = stack.pop()
        kept = _possible(a, b, level, i, j, limit)
        i, j = i[kept], j[kept]
        if not level:
            if a is b:
                kept = i < j
                i, j = i[kept], j[kept]
            if len(i):
                yield i, j
            continue
        below = []
        for tree, at in ((a, i), (b, j)):
            here, under = len(tree.levels[level][0]), len(tree.levels[level - 1][0])
            step = 1 if here == under else FANOUT
            kids = at[:, None] * step + np.arange(step)
            below.append((kids, kids < under))
        (x, in_x), (y, in_y) = below
        left = np.repeat(x[:, :, None], y.shape[1], axis=2).ravel()
        right = np.repeat(y[:, None, :], x.shape[1], axis=1).ravel()
        real = (in_x[:, :, None] & in_y[:, None, :]).ravel()
        if a is b:
            real &= left <= right
        left, right = left[real], right[real]
        for k in range(0, len(left), step_pairs):
            stack.append((level - 1, left[k : k + step_pairs], right[k : k + step_pairs]))


def tree_links(sets: list[np.ndarray], side: np.ndarray | None, limit: Threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs (i, j) of ``sets``; with ``side`` (0 or 1 per set) only
    pairs from different sides. Tokens that one set alone holds can't be in an
    overlap and get no bit; when the others fit :data:`MAX_BITS` the bitmaps are
    exact, else tokens share bits and pairs are verified on the sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    token, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)
    shared = int((seen > 1).sum())
    width = min(MAX_BITS, max(64, -(-shared // 64) * 64))
    owner = np.repeat(np.arange(len(sets)), sizes)
    kept = rank[code] >= 0
    bit = rank[code[kept]] % width
    order = np.lexsort((sizes, [s[0] for s in sets]))  # alike sets often have the same least token
    place = np.empty(len(sets), dtype=np.int64)
    place[order] = np.arange(len(sets))
    bitmaps = np.zeros((len(sets), width // 64), dtype=np.uint64)
    np.bitwise_or.at(bitmaps, (place[owner[kept]], bit // 64), _U64(1) << (bit % 64).astype(np.uint64))
    exact, lone = shared <= width, sizes - np.bincount(owner[kept], minlength=len(sets))

    # tokens of one set alone are outside every overlap: they are no slack
    slack = (sizes - lone)[order] - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)

    def tree(members: np.ndarray) -> SignatureTree:
        return SignatureTree(bitmaps[members], sizes[order][members], slack[members])

    if side is None:
        groups = [np.arange(len(sets))] * 2
        trees = [tree(groups[0])] * 2
    else:
        groups = [np.flatnonzero(side[order] == k) for k in (0, 1)]
        trees = [tree(g) for g in groups]
    if not len(groups[0]) or not len(groups[1]):
        return
    for i, j in dual_traversal(*trees, limit):
        i, j = order[groups[0][i]], order[groups[1][j]]
        if not exact:
            both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], dtype=np.int64)
            good = both >= limit.least_overlap(sizes[i] + sizes[j])
            i, j = i[good], j[good]
        yield i, j


_FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])


def _sets_of(size: int):
    """Batches with the text in their last column to the same with the set's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column(batch.num_columns - 1)):
                sets = pa.array([s.tobytes() for s in shingle_sets(buf, offs, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)), sets], names=[*batch.schema.names[:-1], "items"])

    return run


def _join_blocks(percent: int):
    """Rows sorted by (family, left, right); each run is one task of one or two
    blocks. Returns each linked set with the least set of its component in the
    task and the number of documents it links to there."""
    limit = Threshold(percent)

    def solve(key, docs, weights, blocks, sets) -> pa.RecordBatch | None:
        docs, once = np.unique(np.array(docs, dtype=np.int64), return_index=True)  # repeated rows
        weights, sets = np.array(weights, dtype=np.int64)[once], [sets[k] for k in once.tolist()]
        side = None if key[1] == key[2] else (np.array(blocks)[once] == key[2]).astype(np.int64)
        parent, links = np.arange(len(docs)), np.zeros(len(docs), dtype=np.int64)
        for i, j in tree_links([np.frombuffer(s, dtype=np.uint64) for s in sets], side, limit):
            np.add.at(links, i, weights[j])
            np.add.at(links, j, weights[i])
            while True:  # hook the larger root to the smaller, then point all at their roots
                a, b = parent[i], parent[j]
                open_ = a != b
                if not open_.any():
                    break
                i, j, a, b = i[open_], j[open_], a[open_], b[open_]
                np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
                while (parent[parent] != parent).any():
                    parent = parent[parent]
        has = links > 0
        if not has.any():
            return None
        least = np.full(len(docs), np.iinfo(np.int64).max)
        np.minimum.at(least, parent, docs)
        return pa.RecordBatch.from_arrays([pa.array(docs[has]), pa.array(least[parent][has]), pa.array(links[has])], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for family, left, right, doc, weight, block, items in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (family, left, right) != key:
                    if held and (out := solve(key, *held)):
                        yield out
                    key, held = (family, left, right), ([], [], [], [])
                for column, value in zip(held, (doc, weight, block, items)):
                    column.append(value)
        if held and (out := solve(key, *held)):
            yield out

    return run


def ngram_jaccard_join(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    document reachable by links, itself included), n_links (documents it links
    to directly).

    Null, empty and white-space texts have no shingles and link with nothing;
    rows with the same text link; texts of any length are compared whole. Other
    columns of ``docs`` are ignored whatever their names. ``id_col`` is an
    integer, distinct but for repeated rows, which count as further documents
    with the same text; a row whose id is null links with nothing and has no
    n_shingles and component_id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    limit = Threshold(percent)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = shuffle_partitions(rows, 32 << 20)
    source = rows.where("doc_id is not null")
    with Scratch(spark) as scratch:
        screened = source.mapInArrow(_screen_batch(shingle_words, limit, buckets), _PACKED_DDL)
        screened = screened.repartition(buckets, "bucket").mapInArrow(_count_shared(buckets), _PACKED_DDL)
        sets = scratch.table(screened.repartition(buckets, "bucket").mapInArrow(_decide(limit), _BRIEF_DDL), "ngram-sets")

        # one representative per distinct set, with the number of its documents
        classes = sets.where("n > 0").groupBy("h1", "h2", "n").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.bool_or("active").alias("active")
        )
        classes = scratch.table(classes, "classes")
        wanted = classes.where("active").select(F.col("rep").alias("doc_id")).hint("merge")
        texts = scratch.table(source.join(wanted, "doc_id").select("doc_id", "text"), "ngram-texts")
        signed = texts.mapInArrow(_sign(shingle_words, percent, buckets), _PACKED_DDL)
        stars = signed.repartition(buckets, "bucket").mapInArrow(_link_parts, "u long, v long")
        families = scratch.table(connected_components(stars, scratch), "families")

        members = classes.join(families, classes["rep"] == families["node"]).select("rep", "weight", "n", F.col("component").alias("family"))
        members = scratch.table(_with_blocks(members), "members")
        members = _cut_families(members, texts, shingle_words, limit, buckets, scratch)
        placed = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        # each set to every task of its block
        placed = placed.hint("merge")
        placed = texts.join(placed, texts["doc_id"] == placed["rep"]).select("family", "rep", "weight", "block", "blocks", "text")
        as_sets = placed.mapInArrow(_sets_of(shingle_words), "family long, rep long, weight long, block int, blocks int, items binary")
        partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
        tasks = as_sets.select("family", "rep", "weight", "block", "items", partner).select(
            "family", F.least("block", "partner").alias("left"), F.greatest("block", "partner").alias("right"), "rep", "weight", "block", "items"
        )
        keys = ["family", "left", "right"]
        found = (
            tasks.repartition(buckets, *keys)
            .sortWithinPartitions(*keys)
            .mapInArrow(_join_blocks(percent), "u long, v long, links long")
        )
        found = scratch.table(found, "ngram-links")
        joined = connected_components(found.select("u", "v"), scratch)
        direct = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
        classes = (
            classes.join(direct, "rep", "left")
            .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
            .select("h1", "h2", "n", F.coalesce("component", "rep").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        )
        result = sets.select("doc_id", "h1", "h2", "n").join(classes, ["h1", "h2", "n"], "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
        none = [F.lit(None).cast("long").alias(c) for c in ("n_shingles", "component_id")]
        nameless = rows.where("doc_id is null").select("doc_id", *none, F.lit(0).cast("long").alias("n_links"))
        return scratch.keep(result.unionByName(nameless), "ngram-join")


def keep_one_per_group(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the smallest doc_id of their group, and those
    without a doc_id; all columns."""
    groups = ngram_jaccard_join(docs, shingle_words, percent)
    others = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_other_id")).hint("merge")
    return docs.join(others, docs["doc_id"] == others["_other_id"], "left_anti")
