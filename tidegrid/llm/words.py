"""Words and rolling windows of whole Arrow columns of text, as arrays of 64-bit hashes.

Everything works on the UTF-8 bytes of a column at once, in blocks, so that memory follows the
block and the longest single word, not the product of both.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18

WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
# All but ASCII letters, digits, the underscore and the bytes of characters beyond ASCII.
NON_WORD = np.ones(256, bool)
NON_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = False

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


@functools.cache
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64))


@functools.lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _window_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end], the same wherever the window lies.

    Starts and ends ascend. Windows are taken in runs that span BLOCK values or one window.
    """
    out = np.empty(len(starts), np.uint64)
    inverse = pow(base, -1, 1 << 64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        part = values[low:int(ends[upto - 1])]
        size = 1 << max(18, (len(part)).bit_length())
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _powers(base, size)[:len(part)], out=sums[1:])
        a = starts[at:upto] - low
        out[at:upto] = (sums[ends[at:upto] - low] - sums[a]) * _powers(inverse, size)[a]
        at = upto
    return out


def flat(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins and the last one ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_places(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Starts and ends of all words, and the number of words before each row."""
    apart = separators[data]
    begins = np.ones(len(data) + 1, bool)
    begins[1:] = apart
    begins[offsets] = True
    inside = ~apart
    starts = np.flatnonzero(inside & begins[:-1])
    after = np.append(apart, True)[1:]
    after[offsets[(offsets > 0)] - 1] = True
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashed_words(column, separators: np.ndarray = WHITE, lower: bool = False):
    """All bytes, the words' starts, ends and hashes, and the number of words before each row."""
    data, offsets = flat(column, lower)
    starts, ends, first = word_places(data, offsets, separators)
    hashes = _window_sums(_byte_values()[data] if len(data) <= 4 * BLOCK else _Lazy(data),
                          starts, ends, _BYTE_BASE)
    hashes += (ends - starts).astype(np.uint64)
    return data, starts, ends, mixed(hashes), first


def word_hashes(column, separators: np.ndarray = WHITE, lower: bool = False):
    """A hash for each word of a column, and the number of words before each row."""
    return hashed_words(column, separators, lower)[3:]


class _Lazy:
    """Byte values looked up a slice at a time, to spare eight bytes for each byte of text."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def __getitem__(self, part: slice) -> np.ndarray:
        return _byte_values()[self.data[part]]


def rolling(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which n words of one row begin, and a hash of each such window."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(len(hashes))
    places = np.flatnonzero(left >= n)
    found = _window_sums(hashes, places, places + n, _WORD_BASE)
    found += np.uint64(n)
    return places, mixed(found)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n-word shingle and the number of shingles before each row.

    A row of fewer words, but at least one, has one shingle of all its words.
    """
    counts = np.diff(first)
    places, found = rolling(hashes, first, n)
    sizes = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = _window_sums(hashes, first[short], first[short + 1], _WORD_BASE)
        whole += counts[short].astype(np.uint64)
        at = np.concatenate([[0], np.cumsum(sizes)])[short]
        found = np.insert(found, at, mixed(whole))
        sizes[short] = 1
    return found, np.concatenate([[0], np.cumsum(sizes)])
