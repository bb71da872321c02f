"""Vectorised text kernels: words, word hashes and window hashes over the bytes of an Arrow string column.

Everything works on one slice of a batch at a time (``slices``), so the arrays, which take some tens of bytes per byte of
text, stay small whatever the batch holds; one text alone is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 18
#: Odd multipliers of the polynomial hashes modulo 2**64; the first two are for bytes, the last two for words.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

#: Byte class of words between ASCII white space: everything but 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables are kept per process and grow by doubling."""
    got = _powers.get(base)
    if got is None:
        got = np.array([1], dtype=U64)
    while len(got) < n:
        got = np.concatenate([got, got * U64(pow(base, len(got), 1 << 64))])
    _powers[base] = got
    return got[:n]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, from one prefix sum (Rabin-Karp without a loop)."""
    n = len(values)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * powers(base, n), out=total[1:])
    inverse = pow(base, -1, 1 << 64)
    return (total[end] - total[start]) * powers(inverse, n + 1)[start]


@dataclass
class Words:
    """Words of a slice: byte spans, the text each is in, and the first word of each text (with one entry more)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self, which: int = 0) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=U64)
        h = spans_hash(self.data.astype(U64) + U64(1), self.start, self.end, BYTE_BASES[which])
        return mix(h + (self.end - self.start).astype(U64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at) or at[0] == at[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of bytes of the class ``in_word``, never across two texts."""
    n, texts = len(data), len(offsets) - 1
    inside = in_word[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(doc, np.arange(texts + 1))
    return Words(data, start, end, doc, first)


def windows(hashes: np.ndarray, w: Words, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every window of ``size`` words inside one text, and the index of its first word."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    at = np.arange(n - size + 1)
    at = at[w.doc[: n - size + 1] == w.doc[size - 1 :]]
    return mix(spans_hash(hashes, at, at + size, WORD_BASES[which]) + U64(size)), at


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of values[i:i+size] for every i, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    at = batch.schema.get_field_index(column)
    _, offsets = buffers(batch.column(at))
    low, n = 0, batch.num_rows
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield batch.slice(low, min(high, n) - low)
        low = high


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
