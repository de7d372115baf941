"""Words, word hashes and hashes of word runs, computed for whole Arrow columns at once.

A word is a maximal run of bytes other than the six ASCII blanks, which for UTF-8 text is the pattern
``[^\\x20\\x09-\\x0D]+``. Hashes are polynomials modulo 2**64 over random-looking byte values; a prefix sum over the
column yields the hash of every span by one subtraction, so no loop runs over words. Such polynomials collide on long words
of a known pattern, so a word of more than `LONG_WORD` bytes is hashed by blake2b. A second hash of each word, from other
byte values and another base, checks the first where runs are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
RUN_BASE = 0xD1342543DE82EF95
SECOND_BASE = 0xC2B2AE3D27D4EB4F
#: Of the words' second hash.
CHECK_BASE = 0xA0761D6478BD642F
#: The patterns that make polynomials modulo 2**64 collide need words many times as long.
LONG_WORD = 32
#: Bytes of text whose arrays are in memory together.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool, base: int = BASE) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
    if lower:
        values[ord("A"): ord("Z") + 1] = values[ord("a"): ord("z") + 1]
    return values


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
VALUES = {(lower, base): _byte_values(lower, base) for lower in (False, True) for base in (BASE, CHECK_BASE)}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 12)
        ways = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            ways.append(np.multiply.accumulate(row))
        _powers[base] = tuple(ways)
    return _powers[base]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most about `limit` bytes; a longer row stands alone."""
    ends = np.asarray(offsets_of(column)[0])[1:]
    first = 0
    while first < len(ends):
        start = ends[first - 1] if first else offsets_of(column)[0][0]
        last = max(first + 1, int(np.searchsorted(ends, start + limit, "right")))
        yield first, last
        first = last


def offsets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without NULLs."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    buffers = column.buffers()
    if not len(column):
        return np.zeros(1, width), np.zeros(0, np.uint8)
    offsets = np.frombuffer(buffers[1], width)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets, data


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array, NULL as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.fill_null("") if column.null_count else column


class Words:
    """Words of the rows of a string array: `first[i]` to `first[i + 1]` are the words of row i."""

    def __init__(self, column: pa.Array, lower: bool = False):
        offsets, data = offsets_of(column)
        low, high = int(offsets[0]), int(offsets[-1])
        data = data[low:high]
        offsets = offsets.astype(np.int64) - low
        inside = ~BLANK[data]
        before = np.empty(len(data) + 1, bool)
        before[0] = False
        before[1:] = inside
        before[offsets] = False  # a row never continues the row before it
        after = np.empty(len(data) + 1, bool)
        after[:-1] = inside
        after[-1] = False
        after[offsets] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(starts, offsets)
        self._data, self._bounds, self._lower = data, (starts, ends), lower
        self.hashes = self._hashed(BASE, 0)
        self.count = np.diff(self.first)

    def _hashed(self, base: int, half: int) -> np.ndarray:
        """A hash of each word: a polynomial, or for long words a half of a digest."""
        data, (starts, ends) = self._data, self._bounds
        up, down = powers(base, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUES[self._lower, base][data] * up[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts])
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            word = data[starts[i]: ends[i]].tobytes()
            digest = hashlib.blake2b(word.lower() if self._lower else word, digest_size=16).digest()
            hashes[i] = int.from_bytes(digest[8 * half: 8 * half + 8], "little")
        return hashes

    @cached_property
    def checks(self) -> np.ndarray:
        """A second hash of each word, independent of the first."""
        return self._hashed(CHECK_BASE, 1)

    def run_starts(self, length: int) -> np.ndarray:
        """Indices of the words that start a run of `length` words inside their row."""
        n = len(self.hashes)
        if n < length:
            return np.zeros(0, np.int64)
        last = np.repeat(self.first[1:], self.count)  # end of each word's row
        index = np.arange(n)
        return index[index + length <= last]

    def runs(self, starts: np.ndarray, length: int | np.ndarray, base: int = RUN_BASE) -> np.ndarray:
        """Hash of the `length` words from each start; with `SECOND_BASE` one that rests on the words' second hashes."""
        n = len(self.hashes)
        up, down = powers(base, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        words = self.checks if base == SECOND_BASE else self.hashes
        np.cumsum(mix(words ^ np.uint64(base)) * up[:n], out=sums[1:])
        return mix((sums[starts + length] - sums[starts]) * down[starts])


def shingle_sets(column: pa.Array, size: int, lower: bool) -> list[np.ndarray]:
    """The sorted distinct hashes of each row's runs of `size` words.

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    out: list[np.ndarray] = []
    for low, high in slices(column):
        words = Words(column[low:high], lower)
        starts = words.run_starts(size)
        hashes = words.runs(starts, size)
        bounds = np.searchsorted(starts, words.first)
        short = np.flatnonzero((words.count > 0) & (words.count < size))
        whole = dict(zip(short.tolist(), words.runs(words.first[short], words.count[short]), strict=True))
        for row in range(high - low):
            if row in whole:
                out.append(np.array([whole[row]], np.uint64))
            else:
                out.append(np.unique(hashes[bounds[row]: bounds[row + 1]]))
    return out
