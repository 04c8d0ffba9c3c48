"""Vectorised text helpers shared by the operators: words, hashes and bounded slices.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. In UTF-8
those six separators are single bytes that never occur inside another
character, so words are found on the bytes of an Arrow column directly.
Word and window identity is a 64-bit hash (a polynomial over random byte
values, then mixed); null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 2 << 20
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IN_WORD = np.ones(256, bool)
IN_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = _random(256, 17)
#: Odd multipliers, one for each place of a window.
PLACE = _random(64, 99) | np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1024)
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (nulls are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if off is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that cover all rows in order, each of at most ``limit`` bytes or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


@dataclass
class Words:
    """Words of a run of texts: byte ranges in ``data``; ``first[i]`` is the first word of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts; ``lower`` maps A-Z to a-z first."""
    if lower:
        data = _LOWER[data]
    inside = IN_WORD[data]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets).astype(np.int64))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power(_BASE_INVERSE, n + 1)[start]
    return mix(h + (end - start).astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return range_hashes(words.data, words.start, words.end)


def window_hashes(word: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """A hash of the words at ``places`` after each position (positions up to the last that fits)."""
    n = len(word) - max(places)
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, p in enumerate(places):
        total += word[p : p + n] * PLACE[k]
    return mix(total)


def sequence_hashes(word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of words, from running sums."""
    total = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * _power(_BASE, len(word)), out=total[1:])
    h = (total[end] - total[start]) * _power(_BASE_INVERSE, len(word) + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def window_starts(words: Words, width: int) -> np.ndarray:
    """Word positions from which ``width`` words follow inside the same text."""
    last = np.repeat(words.first[1:], words.counts())
    return np.flatnonzero(np.arange(len(words.start)) + width <= last)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i]+1, ...`` (``count[i]`` of them) for every i, in one array."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - count), count)


class UnitCache:
    """Ids of text units that recur, so each distinct unit is encoded once for a while.

    ``encode(list of bytes)`` gives a list of id lists. The cache lives in the
    Python worker, holds at most ``limit`` units (about 50 bytes each) and
    starts again when full.
    """

    def __init__(self, encode, limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int32)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(4096, np.int32)
        self.start = np.zeros(0, np.int64)
        self.used = 0

    def _add(self, keys: np.ndarray, at: np.ndarray, lists: list) -> None:
        """Take in units with these sorted keys, which belong before places ``at``."""
        n, counts = len(self.keys), np.fromiter(map(len, lists), np.int32, len(lists))
        more = int(counts.sum())
        if len(self.ids) < self.used + more:
            self.ids = np.concatenate([self.ids, np.zeros(max(more, len(self.ids) // 2), np.int32)])
        self.ids[self.used : self.used + more] = np.fromiter((i for x in lists for i in x), np.int32, more)
        self.start = np.append(self.start, self.used + np.cumsum(counts, dtype=np.int64) - counts)
        self.count = np.append(self.count, counts)
        self.used += more
        self.slots = np.insert(self.slots, at, np.arange(n, n + len(lists), dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units in order, and how many each unit has."""
        if len(start) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, at, inverse = np.unique(range_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._reset()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inner = place < len(self.keys)
        new[inner] = self.keys[place[inner]] != keys[inner]
        if new.any():
            a, b = start[at[new]], end[at[new]]
            self._add(keys[new], place[new], self.encode([data[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist())]))
            place = np.searchsorted(self.keys, keys)
        slot = self.slots[place][inverse.ravel()]
        counts = self.count[slot].astype(np.int64)
        return self.ids[ranges(self.start[slot], counts)], counts
