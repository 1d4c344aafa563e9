"""64-bit hashes of the words of an Arrow string column, computed on its UTF-8 buffer.

The hash of a word is a polynomial over its bytes modulo 2**64, each byte
replaced by a fixed random number, so that one running sum over the buffer
gives the hashes of all words.  A finaliser spreads the bits.  Two different
words collide with a chance of about 2**-60; the operators treat equal hashes as
equal words and say so.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 18  # bytes hashed at once; a longer word widens its segment

# Odd constants with well mixed bits; any others would do.
_BASE = 0x9E3779B97F4A7C15
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)

# Space, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def finalise(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (in place)."""
    h ^= h >> np.uint64(30)
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


@cache
def byte_values(lower: bool) -> np.ndarray:
    """The number that stands for each byte; with ``lower`` A-Z share those of a-z."""
    v = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
    if lower:
        v[65:91] = v[97:123]
    return v


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; longer tables are not kept."""
    size = SEGMENT + 1 if n <= SEGMENT + 1 else n
    if size in _POWERS:
        return _POWERS[size]
    pair = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        pair.append(np.multiply.accumulate(p))
    if size == SEGMENT + 1:
        _POWERS[size] = tuple(pair)
    return tuple(pair)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a NULL is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each document (one entry more)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1] if len(data) else inside
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~edge[1:] if len(data) else inside
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True
) -> np.ndarray:
    """A 64-bit hash of each word, segment by segment."""
    out, values, at = np.empty(len(starts), np.uint64), byte_values(lower), 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + SEGMENT, "right")))
        power, inverse = _powers(int(ends[stop - 1] - first) + 1)
        piece = values[data[first : ends[stop - 1]]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * power[: len(piece)], out=sums[1:])
        s, e = starts[at:stop] - first, ends[at:stop] - first
        out[at:stop] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _LENGTH
        at = stop
    return finalise(out)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words; fewer words make one shingle, none none."""
    if not len(words):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        n = min(size, len(words))
        h = np.full(len(words) - n + 1, n * 0x632BE59BD9B4E019 % 2**64, np.uint64)
        for k in range(n):
            h = h * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - n + 1 + k]
    return np.unique(finalise(h))
