"""Alignment of two tokenizers' tokens by an associative monoid of fragments.

The end offsets, in bytes, that tokens of both sides share cut the tokens into
groups. A fragment is what a part of a document says of that: the tokens up to
its first shared end (the open prefix, which a part before may complete), the
closed groups between its shared ends, and the tokens after its last one (the
open suffix). Two neighbours compose by aligning the first one's suffix with
the second one's prefix, which is associative, so a very long document is cut
into byte ranges that different tasks encode, and a tree of small compositions
joins them. Closed groups never travel up the tree.

A document is cut where an encoder certainly starts a new token: the first
tokenizer's pattern parts a letter from what is no letter, the second one has
no piece with a space after another character. The two places of one cut are
different, so the ranges of the two sides are, and seams do have open tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._blocks import BlockBuilder, block_ddl, item_totals, items_of, measured_rows
from tessera.scratch import Scratch, shuffle_partitions

#: Characters of a byte range; longer documents are cut.
CHUNK = 1 << 15
#: Fragments that one node of the tree composes.
FAN = 8
#: Bytes of cut text to a task.
TASK_BYTES = 4 << 20


# -- tokens ----------------------------------------------------------------------


def _byte_level() -> dict[str, int]:
    """Character to byte of a byte-level vocabulary: visible Latin-1 characters
    stand for their bytes, the other bytes follow from 256 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


#: A space after another character, with something behind it: both encoders start a token there.
_WORD_CUT = re.compile(r"(?<! ) (?=.)", re.DOTALL)


def words_of(text: str) -> list[str]:
    """Parts of a text that both encoders take on their own, each without the
    space in front of it (the first one's is the added one)."""
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return _WORD_CUT.split(" " + text)[1:]


class Encoders:
    """Both tokenizers, with one encoding and alignment per distinct word."""

    #: New words that are encoded as one text, each of at most so many characters.
    AT_ONCE, AT_ONCE_CHARS = 256, 64
    #: Forget the known words beyond this number, or this many characters of them.
    MAX_KNOWN, MAX_CHARS = 400_000, 16 << 20

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        level = _byte_level()
        vocabulary = {i: bytes(level.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}
        self.a_bytes = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]
        self.b_bytes = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.texts: list[str] = []
        self.same = np.zeros(0, dtype=bool)
        # ids of either side and link codes of all words, and where each word's start
        self.flat = {k: np.zeros(0, dtype=np.int64) for k in "ab"} | {"link": np.zeros(0, dtype=np.uint64)}
        self.start = {k: np.zeros(1, dtype=np.int64) for k in self.flat}

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def b_ids(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)

    def learn(self, words: list[str]) -> None:
        """Afterwards every word has a number."""
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if len(new) + len(self.texts) > self.MAX_KNOWN or self.chars > self.MAX_CHARS:
            self._reset()
            new = list(dict.fromkeys(words))
        if not new:
            return
        new, (flat_a, n_a), (flat_b, n_b), size, same = self._encoded(new)
        groups = aligned(flat_a, np.cumsum(self.a_size[flat_a]), flat_b, np.cumsum(self.b_size[flat_b]))
        upto = np.searchsorted(groups.ends, np.cumsum(size * same), side="right")
        marked = groups.marked()
        cuts = np.concatenate(([0], groups.a_cuts + groups.b_cuts))[np.concatenate(([0], upto))].tolist()
        self.number |= {w: len(self.texts) + i for i, w in enumerate(new)}
        self.chars += sum(map(len, new))
        self.texts += ["".join(marked[x:y]) for x, y in zip(cuts, cuts[1:])]
        self.same = np.append(self.same, same)
        for k, values, sizes in (("a", flat_a, n_a), ("b", flat_b, n_b), ("link", groups.links(), np.diff(upto, prepend=0))):
            self.start[k] = np.append(self.start[k], self.start[k][-1] + np.cumsum(sizes))
            self.flat[k] = np.append(self.flat[k], values)

    def _encoded(self, new: list[str]) -> tuple[list[str], tuple, tuple, np.ndarray, np.ndarray]:
        """Words in another order, ids and their number to a word of either side,
        bytes of each word with its space, and whether both sides give these
        back (if not, it has no ids)."""
        joint, single = [], []
        for w in new:
            (joint if w and len(w) <= self.AT_ONCE_CHARS and w[0] != " " and w[-1] != " " else single).append(w)
        order: list[str] = []
        ids: tuple[list, list] = ([], [])
        numbers: tuple[list, list] = ([], [])
        sizes, same = [], []
        # words with one space between them are a text that both encoders cut there again
        parts = [joint[i : i + self.AT_ONCE] for i in range(0, len(joint), self.AT_ONCE)]
        texts = [" ".join(part) for part in parts]
        for part, text, *both in zip(parts, texts, self.a_ids([" " + t for t in texts]), self.b_ids(texts)):
            size = np.fromiter(map(len, part if text.isascii() else [w.encode() for w in part]), dtype=np.int64, count=len(part)) + 1
            found = [self._cut_at(x, size, (" " + text).encode(), *tables) for x, tables in zip(both, ((self.a_bytes, self.a_size), (self.b_bytes, self.b_size)))]
            if found[0] is None or found[1] is None:  # some word's bytes don't come back
                single += part
                continue
            for i in (0, 1):
                ids[i].append(found[i][0])
                numbers[i].append(found[i][1])
            order += part
            sizes.append(size)
            same.append(np.ones(len(part), dtype=bool))
        if single:
            spaced = [" " + w for w in single]
            raw = [w.encode() for w in spaced]
            a, b = self.a_ids(spaced), self.b_ids(single)
            good = [b"".join(map(self.a_bytes.__getitem__, x)) == r == b"".join(map(self.b_bytes.__getitem__, y)) for x, y, r in zip(a, b, raw)]
            for i, side in enumerate((a, b)):
                side = [x if s else [] for x, s in zip(side, good)]
                ids[i].append(np.array([i for x in side for i in x], dtype=np.int64))
                numbers[i].append(np.array([len(x) for x in side], dtype=np.int64))
            order += single
            sizes.append(np.array([len(r) for r in raw], dtype=np.int64))
            same.append(np.array(good))
        sides = [(np.concatenate(x), np.concatenate(n)) for x, n in zip(ids, numbers)]
        return order, sides[0], sides[1], np.concatenate(sizes), np.concatenate(same)

    @staticmethod
    def _cut_at(ids: list[int], size: np.ndarray, raw: bytes, table: list[bytes], table_size: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text of words, and their number to a word; None unless the
        tokens give back its bytes and one ends with each word."""
        if b"".join(map(table.__getitem__, ids)) != raw:
            return None
        ids = np.array(ids, dtype=np.int64)
        ends, words = np.cumsum(table_size[ids]), np.cumsum(size)
        upto = np.searchsorted(ends, words)
        return (ids, np.diff(upto + 1, prepend=0)) if (ends[upto] == words).all() else None

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))

    def sizes(self, kind: str, words: np.ndarray) -> np.ndarray:
        return self.start[kind][words + 1] - self.start[kind][words]

    def of(self, kind: str, words: np.ndarray) -> np.ndarray:
        """What the words have of a kind, one after the other."""
        size = self.sizes(kind, words)
        before = np.cumsum(size) - size
        return self.flat[kind][np.repeat(self.start[kind][words] - before, size) + np.arange(size.sum())]

    def ids(self, kind: str, text: str) -> tuple[np.ndarray, bool]:
        """One side's ids of a text, which may start without a space; whether
        their bytes are the text's."""
        encode, table = (self.a_ids, self.a_bytes) if kind == "a" else (lambda x: self.b_ids([t[1:] for t in x]), self.b_bytes)
        head = np.zeros(0, dtype=np.int64)
        if text and text[0] != " ":  # up to the next certain cut
            cut = _WORD_CUT.search(text)
            first, text = (text[: cut.start()], text[cut.start() :]) if cut else (text, "")
            head = np.array(encode([first])[0], dtype=np.int64)
            if b"".join(map(table.__getitem__, head.tolist())) != first.encode():
                return head, False
        if len(text) < 2:  # nothing, or a space alone
            tail = encode([text])[0] if text and kind == "a" else [self.b.piece_to_id("▁")] if text else []
            return np.append(head, np.array(tail, dtype=np.int64)), True
        words = words_of(text[1:])
        self.learn(words)
        numbers = self.numbers(words)
        return np.append(head, self.of(kind, numbers)), bool(self.same[numbers].all())


@lru_cache(maxsize=1)
def _encoders(a_path: str, b_path: str) -> Encoders:
    return Encoders(a_path, b_path)


# -- the monoid ------------------------------------------------------------------


@dataclass
class Groups:
    """Tokens of both sides, cut at ``ends``, the offsets where both end."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray  # tokens up to each of the ends
    b_cuts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    def marked(self) -> list[str]:
        """Every token of the groups with what follows it in their text: a comma,
        a bar behind a group's last one of the first side, a semicolon."""
        if not len(self):
            return []
        n_a, n_b = np.diff(self.a_cuts, prepend=0), np.diff(self.b_cuts, prepend=0)
        a, b = self.a[: self.a_cuts[-1]], self.b[: self.b_cuts[-1]]
        comma, bar, semicolon = _marks(max(1 << 16, 1 << int(max(a.max(), b.max())).bit_length()))
        out = np.empty(len(a) + len(b), dtype=object)
        at_a = np.arange(len(a)) + np.repeat(self.b_cuts - n_b, n_a)
        at_b = np.arange(len(b)) + np.repeat(self.a_cuts, n_b)
        out[at_a], out[at_b] = comma[a], comma[b]
        out[at_a[self.a_cuts - 1]], out[at_b[self.b_cuts - 1]] = bar[a[self.a_cuts - 1]], semicolon[b[self.b_cuts - 1]]
        return out.tolist()

    def text(self) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        return "".join(self.marked())[:-1]

    def texts(self) -> list[str]:
        return self.text().split(";") if len(self) else []

    def links(self) -> np.ndarray:
        """The pairs of tokens that end together, first side's id above the second's."""
        return (self.a[self.a_cuts - 1].astype(np.uint64) << np.uint64(32)) | self.b[self.b_cuts - 1].astype(np.uint64)

    def part(self, first: int, last: int) -> Groups:
        """Groups ``first`` to ``last`` (exclusive)."""
        a0, b0 = (int(x[first - 1]) if first else 0 for x in (self.a_cuts, self.b_cuts))
        a1, b1 = (int(x[last - 1]) if last else 0 for x in (self.a_cuts, self.b_cuts))
        return Groups(self.a[a0:a1], self.b[b0:b1], self.a_cuts[first:last] - a0, self.b_cuts[first:last] - b0, self.ends[first:last])


@lru_cache(maxsize=2)
def _marks(n: int) -> tuple[np.ndarray, ...]:
    """The numbers up to ``n`` as text, with a comma, a bar and a semicolon."""
    return tuple(np.array([f"{i}{mark}" for i in range(n)], dtype=object) for mark in ",|;")


def aligned(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Groups of tokens with increasing ends; tokens after the last shared end belong to none."""
    if not len(a_ends):
        return Groups(a, b, a_ends, a_ends, a_ends)
    place = np.minimum(np.searchsorted(a_ends, b_ends), len(a_ends) - 1)
    shared = np.flatnonzero(a_ends[place] == b_ends)
    return Groups(a, b, place[shared] + 1, shared + 1, b_ends[shared])


@dataclass
class Side:
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))

    def __add__(self, other: Side) -> Side:
        return Side(np.append(self.ids, other.ids), np.append(self.ends, other.ends))

    def between(self, low: int | None, high: int | None) -> Side:
        """Tokens with low < end <= high."""
        x = 0 if low is None else int(np.searchsorted(self.ends, low, side="right"))
        y = len(self.ends) if high is None else int(np.searchsorted(self.ends, high, side="right"))
        return Side(self.ids[x:y], self.ends[x:y])


@dataclass
class Fragment:
    """Open prefix and suffix of both sides; without a shared end (``cut``)
    all tokens are in the prefix. Closed groups are kept apart."""

    prefix: tuple[Side, Side]
    suffix: tuple[Side, Side]
    cut: bool


def fragment(a: Side, b: Side) -> tuple[Fragment, Groups]:
    """The fragment of tokens, and its closed groups."""
    groups = aligned(a.ids, a.ends, b.ids, b.ends)
    if not len(groups):
        return Fragment((a, b), (Side(), Side()), False), groups
    first, last = int(groups.ends[0]), int(groups.ends[-1])
    prefix, suffix = tuple(x.between(None, first) for x in (a, b)), tuple(x.between(last, None) for x in (a, b))
    return Fragment(prefix, suffix, True), groups.part(1, len(groups))


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Groups]:
    """Two neighbours as one, and the groups that this closes."""
    left = x.suffix if x.cut else x.prefix
    seam, closed = fragment(left[0] + y.prefix[0], left[1] + y.prefix[1])
    if not x.cut:  # the seam's first group is still open to the left
        return Fragment(seam.prefix, y.suffix if y.cut else seam.suffix, seam.cut), closed
    if not seam.cut:
        return Fragment(x.prefix, seam.prefix, True), closed
    whole = aligned(*(v for i in (0, 1) for v in ((left[i] + y.prefix[i]).ids, (left[i] + y.prefix[i]).ends)))
    return Fragment(x.prefix, y.suffix if y.cut else seam.suffix, True), whole


# -- documents that fit a range -----------------------------------------------------

_ROW = [("key", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())]
_ROW_DDL = "key long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string"
#: Characters of documents that are encoded together.
TOGETHER = 1 << 20


def _decoded(raw: bytes | None) -> str:
    """Null and malformed texts are empty: neither has tokens."""
    try:
        return (raw or b"").decode()
    except UnicodeDecodeError:
        return ""


def _batches(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < TOGETHER:
            size += len(texts[end])
            end += 1
        yield ids[at:end], texts[at:end]
        at = end


def _whole_documents(a_path: str, b_path: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, blocks = _encoders(a_path, b_path), BlockBuilder(_ROW)
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [_decoded(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            for ids, part in _batches(batch.column(0).to_pylist(), texts):
                words = [words_of(t) if t else [] for t in part]
                cuts = np.concatenate(([0], np.cumsum([len(w) for w in words])))
                flat = [w for x in words for w in x]
                encoders.learn(flat)
                number = encoders.numbers(flat)
                owner = np.repeat(np.arange(len(part)), np.diff(cuts))
                good = np.bincount(owner, weights=~encoders.same[number], minlength=len(part)) == 0
                good &= np.diff(cuts) > 0
                kept, keeper = number[good[owner]], owner[good[owner]]
                n_a, n_b, n_groups = (np.bincount(keeper, weights=encoders.sizes(k, kept), minlength=len(part)).astype(np.int64) for k in ("a", "b", "link"))
                lists, bounds = number.tolist(), cuts.tolist()
                groups = ["".join(map(encoders.texts.__getitem__, lists[x:y]))[:-1] if g else "" for x, y, g in zip(bounds, bounds[1:], good.tolist())]
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in groups]
                columns = [range(key, key + len(part)), ids, pa.array(n_a), pa.array(n_b), pa.array(n_groups), digests, groups if with_groups else [None] * len(part)]
                key += len(part)
                yield from blocks.add(columns, np.repeat(keeper, encoders.sizes("link", kept)), encoders.of("link", kept))
        yield from blocks.flush()

    return run


# -- documents in several ranges ------------------------------------------------------

_CUT_A = re.compile(r"(?<=[A-Za-z])(?=[\x00-\x40\x5B-\x60\x7B-\x7F])")
CHUNK_DDL = "key long, doc_id long, chunk int, a_text string, a_at long, b_text string, b_at long"


def ranges_of(text: str, size: int) -> list[tuple[str, int, str, int]]:
    """The text behind a space in ranges of about ``size`` characters: first
    side's part and byte offset, second side's. A range is empty on a side that
    has no certain cut in it."""
    full = " " + text
    cuts: list[list[int]] = [[0, 0]]
    for x in range(size, len(full), size):
        a, b = (pattern.search(full, max(x, last)) for pattern, last in ((_CUT_A, cuts[-1][0]), (_WORD_CUT, cuts[-1][1])))
        cuts.append([m.start() if m else len(full) for m in (a, b)])
    cuts.append([len(full)] * 2)
    out, at_a, at_b = [], 0, 0
    for (a, b), (a_end, b_end) in zip(cuts, cuts[1:]):
        part_a, part_b = full[a:a_end], full[b:b_end]
        out.append((part_a, at_a, part_b, at_b))
        at_a += len(part_a.encode())
        at_b += len(part_b.encode())
    return out


def _cut_documents(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = -1 - (TaskContext.get().partitionId() << 32)  # apart from those of whole documents
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                rows = [(key, doc_id, i, *x) for i, x in enumerate(ranges_of(_decoded(raw), size))]
                key -= 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "chunk", "a_text", "a_at", "b_text", "b_at"])

    return run


_OPEN = [f"{part}_{side}_{what}" for part in ("prefix", "suffix") for side in "ab" for what in ("ids", "ends")]
_FRAGMENT = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("cut", pa.bool_()), ("same", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in _OPEN]
    + [("seam", pa.bool_()), ("n_groups", pa.int64()), ("groups", pa.string()), ("links", pa.binary())]
)
_FRAGMENT_DDL = (
    "key long, doc_id long, chunk int, cut boolean, same boolean, n_a long, n_b long, "
    + ", ".join(f"{c} array<long>" for c in _OPEN)
    + ", seam boolean, n_groups long, groups string, links binary"
)


def _fragment_row(key, doc_id, chunk, x: Fragment, same: bool, n_a: int, n_b: int) -> dict:
    sides = (v for side in (*x.prefix, *x.suffix) for v in (side.ids.tolist(), side.ends.tolist()))
    return {"key": key, "doc_id": doc_id, "chunk": chunk, "cut": x.cut, "same": same, "n_a": n_a, "n_b": n_b} | dict(zip(_OPEN, sides))


def _part_row(key, chunk, groups: Groups, seam: bool) -> dict:
    """Closed groups: those of a range, or those of the seam in front of it."""
    return {"key": key, "chunk": chunk, "seam": seam, "n_groups": len(groups), "groups": groups.text(), "links": groups.links().astype("<u8").tobytes()}


def _read_fragment(row: dict) -> Fragment:
    side = [Side(*(np.array(row[c], dtype=np.int64) for c in _OPEN[i : i + 2])) for i in range(0, 8, 2)]
    return Fragment((side[0], side[1]), (side[2], side[3]), row["cut"])


def _fragments(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(a_path, b_path)
        for batch in batches:
            for row in batch.to_pylist():
                a, good_a = encoders.ids("a", row["a_text"])
                b, good_b = encoders.ids("b", row["b_text"])
                sides = [Side(ids, at + np.cumsum(size[ids])) for ids, at, size in ((a, row["a_at"], encoders.a_size), (b, row["b_at"], encoders.b_size))]
                same = good_a and good_b
                x, closed = fragment(*sides) if same else (Fragment((Side(), Side()), (Side(), Side()), False), aligned(*[np.zeros(0, dtype=np.int64)] * 4))
                rows = [_fragment_row(row["key"], row["doc_id"], row["chunk"], x, same, len(a), len(b))]
                if len(closed):
                    rows.append(_part_row(row["key"], row["chunk"], closed, False))
                yield pa.RecordBatch.from_pylist(rows, schema=_FRAGMENT)

    return run


def _compose_node(table: pa.Table) -> pa.Table:
    """The fragments of one node as one, and the groups that its seams close."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    whole, out = _read_fragment(rows[0]), []
    for row in rows[1:]:
        whole, closed = compose(whole, _read_fragment(row))
        if len(closed):
            out.append(_part_row(row["key"], row["chunk"], closed, True))
    same, n_a, n_b = all(r["same"] for r in rows), sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows)
    out.append(_fragment_row(rows[0]["key"], rows[0]["doc_id"], rows[0]["chunk"], whole, same, n_a, n_b))
    return pa.Table.from_pylist(out, schema=_FRAGMENT)


def _first_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's start closes the prefix of its whole fragment."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            x = _read_fragment(row)
            groups = aligned(x.prefix[0].ids, x.prefix[0].ends, x.prefix[1].ids, x.prefix[1].ends)
            if len(groups):
                rows.append(_part_row(row["key"], -1, groups, True))
        yield pa.RecordBatch.from_pylist(rows, schema=_FRAGMENT)


def _digests(with_groups: bool):
    """Rows in the order of their documents' groups: one digest a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, n, texts = None, None, 0, []

        def done() -> pa.RecordBatch:
            columns = [pa.array([key], pa.int64()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()]), pa.array([";".join(texts) if with_groups else None], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "n_groups", "groups_sha256", "groups"])

        for batch in batches:
            for k, more, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k != key:
                    if key is not None:
                        yield done()
                    key, digest, n, texts = k, hashlib.sha256(), 0, []
                digest.update((";" if n else "").encode() + text.encode())
                n += more
                if with_groups:
                    texts.append(text)
        if key is not None:
            yield done()

    return run


_PART = [("key", pa.int64())]


def _link_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks = BlockBuilder(_PART)
    for batch in batches:
        links = [np.frombuffer(x, dtype="<u8") for x in batch.column(1).to_pylist()]
        if links:
            yield from blocks.add([batch.column(0)], np.repeat(np.arange(len(links)), [len(x) for x in links]), np.concatenate(links))
    yield from blocks.flush()


def _long_documents(docs: DataFrame, a_path: str, b_path: str, chunk: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Whole fragments (key, doc_id, same, n_a, n_b), and parts (key, chunk,
    seam, n_groups, groups, links) of documents whose bytes agree."""
    ranges = scratch.table(docs.mapInArrow(_cut_documents(chunk), CHUNK_DDL), "ranges")
    dealt = ranges.repartition(shuffle_partitions(ranges, TASK_BYTES), "key", "chunk")
    found = scratch.table(dealt.mapInArrow(_fragments(a_path, b_path), _FRAGMENT_DDL), "fragments")
    longest = found.agg(F.max("chunk")).first()[0]
    level, parts = found.where("seam is null"), [found.where("seam is not null")]
    width = 1
    while longest is not None and longest >= width:
        width *= FAN
        node = F.floor(F.col("chunk") / width).cast("int")
        found = scratch.table(level.withColumn("node", node).groupBy("key", "node").applyInArrow(lambda t: _compose_node(t.drop_columns(["node"])), _FRAGMENT_DDL), "composed")
        level = found.where("seam is null")
        parts.append(found.where("seam is not null"))
    parts.append(level.mapInArrow(_first_groups, _FRAGMENT_DDL))
    columns = ["key", "chunk", "seam", "n_groups", "groups", "links"]
    all_parts = parts[0].select(columns)
    for x in parts[1:]:
        all_parts = all_parts.unionByName(x.select(columns))
    whole = scratch.table(level.select("key", "doc_id", "same", "n_a", "n_b"), "whole")
    return whole, all_parts.join(whole.where("same").select("key"), "key")


def token_alignment(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256 and, ``with_groups``, the groups
    themselves as text: ``a1,a2|b1;a3|b2,b3``, ids of either side.

    The first tokenizer (a byte-level vocabulary of ``tokenizers``) encodes the
    text behind a space, the second one (a ``sentencepiece`` model with byte
    fallback) the text, before which it puts a space itself. Tokens that end at
    the same byte are linked; a pair of ids counts its links in all of ``docs``;
    n_best are links whose pair is the commonest of its second id, of equal ones
    each, count_sum adds up the counts of a document's links.

    Null, empty and malformed texts, and texts whose bytes one side's tokens do
    not give back, have no tokens: zeros, an empty digest, and no part in the
    counts. Equal texts and repeated rows are rows like others, doc_id may be
    null, other columns are ignored, an empty table gives an empty result. Both
    files must be the same on every executor. Documents of more than ``chunk``
    characters are encoded in ranges by different tasks.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    with Scratch(docs.sparkSession) as scratch:
        blocks = scratch.table(source.where(~is_long).mapInArrow(_whole_documents(a_path, b_path, with_groups), block_ddl(_ROW_DDL)), "documents")
        whole, parts = _long_documents(source.where(is_long), a_path, b_path, chunk, scratch)
        parts = scratch.table(parts, "parts")
        long_blocks = scratch.table(parts.select("key", "links").mapInArrow(_link_blocks, block_ddl("key long")), "links")
        totals = item_totals(items_of(blocks).unionByName(items_of(long_blocks)))
        totals = scratch.table(totals.withColumn("b", F.col("item").bitwiseAND(0xFFFFFFFF)), "pairs")
        best = totals.groupBy("b").agg(F.max("total").alias("most"))
        totals = scratch.table(totals.join(best, "b").select("item", "total", (F.col("total") == F.col("most")).alias("best")), "best")

        def measures(known: pa.Table) -> dict[str, np.ndarray]:
            total = np.asarray(known.column("total"))
            return {"n_best": np.asarray(known.column("best")), "count_sum": total}

        kinds = {"n_best": "long", "count_sum": "long"}
        short_rows = measured_rows(blocks, totals, measures, kinds)
        order = parts.repartition(shuffle_partitions(parts, TASK_BYTES), "key").sortWithinPartitions("key", "chunk", F.desc("seam"))
        digests = order.select("key", "n_groups", "groups").mapInArrow(_digests(with_groups), "key long, n_groups long, groups_sha256 string, groups string")
        sums = measured_rows(long_blocks, totals, measures, kinds).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        long_rows = whole.join(digests, "key", "left").join(sums, "key", "left")
        zero = lambda c: F.when(F.col("same"), F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c)
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_best", "count_sum"]
        long_rows = long_rows.select("doc_id", *[zero(c) for c in columns[1:]], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"), F.when(F.lit(with_groups), F.coalesce("groups", F.lit(""))).alias("groups"))
        result = scratch.keep(short_rows.select(long_rows.columns).unionByName(long_rows), "alignment")
    shown = ["doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"]
    return result.select(*shown, *(["groups"] if with_groups else []))
