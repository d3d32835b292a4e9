"""Words of many texts at once, as NumPy arrays over one Arrow buffer.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. UTF-8
never uses those bytes inside a character, so bytes and code points agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], U)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 1 << 18)
        for k, b in enumerate((_BASE, _UNBASE)):
            p = np.full(n, b, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if what is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(what, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes, a longer text alone."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's bounds in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word, from its bytes and length."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = ends - starts
    h = left.astype(U) * U(0xD6E8FEB86659FD93)
    live, at = np.arange(len(starts)), starts
    while len(live):
        h[live] = mix((h[live] + U(_BASE)) ^ (eight[at] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


class Rolling:
    """Hashes of any run of consecutive words in O(1), by a polynomial modulo 2**64."""

    def __init__(self, h: np.ndarray):
        self.power, self.inverse = _tables(len(h) + 1)
        self.sums = np.zeros(len(h) + 1, U)
        np.cumsum(h * self.power[: len(h)], out=self.sums[1:])

    def all(self, k: int) -> np.ndarray:
        """For each start of ``k`` words."""
        n = max(0, len(self.sums) - k)
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])
