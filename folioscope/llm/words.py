"""Words, shingles and n-grams of whole Arrow batches, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Nothing here looks at one
word at a time: word hashes come from running sums over the bytes of many documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_random = np.random.Generator(np.random.PCG64(20240229))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
JOIN = np.uint64(0xD6E8FEB86659FD93)
HASH_BLOCK = 1 << 20  # bytes whose running sums are held at once


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Texts:
    """The bytes of a string column: ``data`` and n + 1 ``bounds``; a null is an empty text."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        self.bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)

    def slices(self, limit: int) -> Iterator[tuple[int, int]]:
        """Runs of documents of at most ``limit`` bytes; a longer document stands alone."""
        first, n = 0, len(self.bounds) - 1
        while first < n:
            last = int(np.searchsorted(self.bounds, self.bounds[first] + limit, "right")) - 1
            last = min(max(last, first + 1), n)
            yield first, last
            first = last

    def words(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of documents first..last, and the number of words of each document."""
        low = self.bounds[first]
        data, bounds = self.data[low : self.bounds[last]], self.bounds[first : last + 1] - low
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(last - first, np.int64)
        inside = ~SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)  # a word cannot cross from one document into the next
        edge[bounds] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        counts = np.diff(np.searchsorted(starts, bounds))
        return _word_hashes(data, starts, ends), counts


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + HASH_BLOCK, "right")), first + 1)
        low, high = starts[first], ends[last - 1]
        size = int(high - low)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(BYTE_CODE[data[low:high]] * _cached_powers(BASE, size), out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (sums[e] - sums[s]) * _cached_powers(BASE_INVERSE, size)[s]
        first = last
    return mixed(out)


_powers_of: dict[int, np.ndarray] = {}


def _cached_powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers_of.get(int(base))
    if have is None or len(have) < n:
        if n > HASH_BLOCK:
            return _powers(base, n)
        have = _powers_of[int(base)] = _powers(base, HASH_BLOCK)
    return have[:n]


def shingles(words: np.ndarray, counts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; a shorter text is one shingle, an empty one has none."""
    n = len(words)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = rolled * JOIN + words[k : k + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for d, c in enumerate(counts.tolist()):
        f = firsts[d]
        if c >= width:
            out.append(np.unique(rolled[f : f + c - width + 1]))
        elif c:
            whole = np.uint64(c)
            for w in words[f : f + c]:
                whole = np.uint64((int(whole) * int(JOIN) + int(w)) % 2**64)
            out.append(mixed(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def counted(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each stands there."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[at], np.diff(np.concatenate([at, [len(sorted_keys)]]))
