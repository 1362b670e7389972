"""Whole text columns as numpy arrays: words, hashes, shingles.

Everything here works on UTF-8 bytes. The separators of all word patterns in use are
ASCII, and no byte of a longer character is ASCII, so cutting bytes cuts characters
correctly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text handled at a time. A longer single text is handled alone.
BLOCK_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: One odd multiplier per place in a shingle.
_PLACES = [U64(pow(0xD6E8FEB86659FD93, j, 1 << 64)) for j in range(16)]

#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``limit`` bytes; at least one row each."""
    n = len(column)
    if not n:
        return
    offsets = _offsets(column)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, max(start + 1, stop))
        yield start, stop
        start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after the other, and where each row begins; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(column)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """The words of several texts.

    ``first[d] : first[d + 1]`` are the words of text d; word w is
    ``data[start[w] : end[w]]``.
    """

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, a: int, b: int) -> bytes:
        return self.data[a:b].tobytes()

    def hashes(self) -> np.ndarray:
        """64 bits of each word's bytes."""
        return span_hashes(self.data, self.start, self.end)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any span follows; one longer than ``data``."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hashes(data, start, end, sums=None, inverse=None) -> np.ndarray:
    sums = prefix_hash(data) if sums is None else sums
    inverse = powers(_BASE_INVERSE, len(data) + 1) if inverse is None else inverse
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


def inverse_powers(n: int) -> np.ndarray:
    return powers(_BASE_INVERSE, n)


def words(column: pa.Array, member: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """Maximal runs of bytes in ``member``, after ``fold``, row by row."""
    data, offsets = text_bytes(column)
    data = fold[data]
    inside = member[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1]
    before[begins[begins < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = offsets[1:] - 1
    after[ends[ends >= 0]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64 bits of each run of k words, wherever texts begin; len(h) - k + 1 of them."""
    m = max(len(h) - k + 1, 0)
    out = np.full(m, U64(k))
    for j in range(k):
        out += h[j : j + m] * _PLACES[j]
    return mix(out)


def shingle_sets(w: Words, k: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of k words.

    A text of fewer words has one, of all its words; a text without words has none.
    """
    h = w.hashes()
    runs = window_hashes(h, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            run = np.sort(runs[a : b - k + 1])
            keep = np.empty(len(run), bool)
            keep[0] = True
            np.not_equal(run[1:], run[:-1], out=keep[1:])
            out.append(run[keep])
        elif b > a:
            out.append(window_hashes(h[a:b], b - a))
        else:
            out.append(np.zeros(0, U64))
    return out
