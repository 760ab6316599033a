"""Packing token sequences by best-fit decreasing.

Documents are tokenized and packed where their rows are: every input partition
fills windows of its own, so nothing is shuffled, and memory holds the token
ids of one partition. A document longer than a window is first cut into full
windows; what is left of all documents goes, longest first, into the open
window with the least room that still takes it, which a segment tree indexed by
remaining capacity finds. At the end the few windows with more than a little
room are emptied again and their tokens are laid out as full windows, then as
one sequence per power of two, which takes no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import LOWER, SPACE, chunks, span_hash, words

WINDOW = 4096
END_ID = 2
#: A packed window with more room than this share of it is laid out anew.
LOOSE = 1 / 64


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_TAIL = np.zeros(256, dtype=bool)
_TAIL[[ord(c) for c in ".,;:!?"]] = True


class WordEncoder:
    """Token ids of whole texts, with one encoding per distinct word.

    For tokenizers that lower-case and split at white space and between letters
    and punctuation: a word with one punctuation mark at its end is looked up as
    two, and A-Z counts as a-z (except where a special token's opening occurs).
    Known words are found by a 64-bit hash. New words of letters are encoded
    many to a call and parted again at the ids that end a word."""

    #: Forget the known words beyond this number.
    MAX_KNOWN = 1 << 21
    PER_CALL = 256

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted
        self.start = self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        groups = [plain[k : k + self.PER_CALL] for k in range(0, len(plain), self.PER_CALL)]
        for group, ids in zip(groups, self._ids([" ".join(texts[i] for i in g) for g in groups])):
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                for i, part in zip(group, np.split(ids, cuts[:-1])):
                    out[i] = part
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._ids([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _learn(self, raw: bytes, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        found = self._encode_words([raw[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist())])
        count = np.array([len(x) for x in found], dtype=np.int64)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, *found])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.count = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.start, first), (self.count, count)))

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """Ids of every row of a chunk."""
        raw = buf.tobytes()
        if b"<|" not in raw:
            buf = LOWER[buf]
            raw = buf.tobytes()
        start, end, first = words(buf, offs, ~SPACE)
        tail = _TAIL[buf[end - 1]] & (end - start > 1) & _LETTER[buf[end - 2]]
        at = np.flatnonzero(tail) + 1
        end = np.insert(end - tail, at, end[tail])
        start = np.insert(start, at, end[np.flatnonzero(tail) + np.arange(len(at))])
        first = first + np.concatenate(([0], np.cumsum(tail)))[first]
        hasher = span_hash(41)
        keys, at, back = np.unique(hasher.spans(hasher.prefix(buf), start, end), return_index=True, return_inverse=True)
        if len(self.keys) > self.MAX_KNOWN:
            self._reset()
        where = np.searchsorted(self.keys, keys)
        new = np.append(self.keys, np.uint64(0))[where] != keys
        new |= where == len(self.keys)
        if new.any():
            self._learn(raw, keys[new], start[at[new]], end[at[new]])
        known = np.searchsorted(self.keys, keys)[back]
        count = self.count[known]
        total = np.concatenate(([0], np.cumsum(count)))
        flat = self.ids[np.repeat(self.start[known] - total[:-1], count) + np.arange(total[-1])]
        cuts = total[first]
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per Python worker: later partitions find the words of earlier ones."""
    return WordEncoder(path)


class RoomTree:
    """Open windows by remaining capacity 0..capacity, in a segment tree that
    counts the windows below each node."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need that an open window has."""
        node = need + self.leaves
        if not self.count[node]:
            while node & 1 or not self.count[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        return node - self.leaves

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of ``lengths`` (1..capacity each) per window, in the order placed."""
    tree, out = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = tree.tightest(lengths[i])
        if room is None:
            out.append([])
            window, room = len(out) - 1, capacity
        else:
            window = tree.take(room)
        out[window].append(i)
        tree.put(window, room - lengths[i])
    return out


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token of
    documents with the given lengths once."""
    out, rest = [], []
    for doc, n in enumerate(lengths):
        full = n // window
        out += [[(doc, k * window, window)] for k in range(full)]
        if n % window:
            rest.append((doc, full * window, n % window))
    loose: list[tuple[int, int, int]] = []
    for members in best_fit_decreasing([p[2] for p in rest], window):
        pieces = [rest[i] for i in members]
        if window - sum(p[2] for p in pieces) > window * LOOSE:
            loose += pieces
        else:
            out.append(pieces)
    left = sum(p[2] for p in loose)
    sizes = [window] * (left // window) + [1 << b for b in range(window.bit_length(), -1, -1) if left % window >> b & 1]
    for size in sizes:
        sequence = []
        while size:
            doc, start, n = loose.pop()
            took = min(n, size)
            sequence.append((doc, start, took))
            size -= took
            if took < n:
                loose.append((doc, start + took, n - took))
        out.append(sequence)
    return out


_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_partition(path: str, end_id: int, window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, owners, tokens = _encoder(path), [], []
        for batch in batches:
            owners += batch.column(0).to_pylist()
            for _, _, buf, offs in chunks(batch.column(1)):
                tokens += [np.append(x, np.uint32(end_id)).astype("<u4") for x in encoder.encode(buf, offs)]
        first = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        for sequence, pieces in enumerate(pack([len(t) for t in tokens], window)):
            offset = 0
            for doc, start, n in pieces:
                ids = tokens[doc][start : start + n]
                rows.append((owners[doc], start, n, zlib.crc32(ids.tobytes()), len(tokens[doc]), first + sequence, offset, *([ids] if with_ids else [])))
                offset += n
            if len(rows) >= 4096:
                yield _batch(rows, with_ids)
                rows = []
        if rows:
            yield _batch(rows, with_ids)

    return run


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    if with_ids:
        arrays.append(pa.array([x.astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names=[*_PIECE.names, *(["ids"] if with_ids else [])])


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start (its tokens before it),
    length, ids_crc32 (of the ids as little-endian unsigned 32-bit integers),
    doc_tokens (with the end id), sequence_id, offset (in the sequence, gapless
    from 0) and, with ``with_ids``, ids.

    Null and empty texts are the end id alone; a null doc_id is kept as it is. Every token lies in one piece; a
    sequence holds at most ``window`` tokens. Equal texts and repeated ids are
    packed like others, other columns are ignored, an empty table gives an empty
    result. ``tokenizer_path`` must be the same on every executor.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    ddl = _PIECE_DDL + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(_pack_partition(tokenizer_path, end_id, window, with_ids), ddl)
