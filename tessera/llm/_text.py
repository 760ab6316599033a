"""Vectorised text helpers shared by the operators of this subpackage.

Everything here works on one Arrow batch at a time: the UTF-8 bytes of a batch
are one NumPy buffer with row offsets, words and lines are index arrays into
it, and hashes come from prefix sums, so no Python loop runs over characters or
words. Batches are cut into chunks of about :data:`CHUNK_BYTES`; a single row
longer than that is a chunk of its own, rows are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: [\x20\x09-\x0D]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are (bytes of other characters are all >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hash of any byte span from prefix sums: the sum of a random word
    per byte times a power of an odd base, divided by the power at the start."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**64, size=256, dtype=np.uint64)
        self.base = int(rng.integers(0, 2**64, dtype=np.uint64)) | 5
        self._power = self._inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._power) < n:
            n = max(n, CHUNK_BYTES + 1)
            for name, base in (("_power", self.base), ("_inverse", pow(self.base, -1, 2**64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(self.table[buf] * self._power[: len(buf)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def rolling(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hashes of every span of ``size`` bytes."""
        n = max(0, len(sums) - size)
        return mix((sums[size:] - sums[:n]) * self._inverse[:n])


@lru_cache(maxsize=None)
def span_hash(seed: int) -> SpanHash:
    """One per seed and process, so its power tables are built once."""
    return SpanHash(seed)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them); nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    offs = np.frombuffer(offsets, dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1)
        yield row, end, raw[offs[row] : offs[end]], offs[row : end + 1] - offs[row]
        row = end


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and the index of each
    row's first word (one more entry than rows); a run never crosses rows."""
    inside = is_word[buf]
    first, last = inside.copy(), inside.copy()
    if len(buf):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offs[(offs > 0) & (offs < len(buf))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int, seed: int = 11) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its ``size``-word shingles (words
    are runs without ASCII white space, A-Z lower-cased). A row with fewer words
    has one shingle of all its words; a row without words has none."""
    hasher = span_hash(seed)
    low = LOWER[buf]
    starts, ends, first = words(low, offs, ~SPACE)
    word = hasher.spans(hasher.prefix(low), starts, ends)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(word) - size + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        rolled += word[j : j + n] * factors[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            part = np.sort(rolled[a : b - size + 1])
            out.append(part[np.concatenate(([True], part[1:] != part[:-1]))])
        elif b > a:
            out.append(mix(np.atleast_1d((word[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a))))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
