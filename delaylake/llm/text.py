"""Words of whole Arrow batches with numpy: no Python loop over bytes or words.

A batch is cut into slices of some megabytes of whole texts, so memory follows
the slice, or a single text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that white space separates: all but space, tab, \n, \v, \f, \r.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POW = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the multiplier modulo 2^64."""
    global _POW
    if len(_POW) < n:
        size = max(n, 2 * len(_POW))
        with np.errstate(over="ignore"):
            factors = np.full(size, _ODD)
            factors[0] = 1
            _POW = np.cumprod(factors, dtype=np.uint64)
    return _POW[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection."""
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    column: pa.Array, most: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, bytes, offsets) of runs of whole texts of about ``most`` bytes."""
    data, offsets = buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        past = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        past = min(rows, max(past, first + 1))
        cut = offsets[first : past + 1]
        yield first, past, data[cut[0] : cut[-1]], cut - cut[0]
        first = past


def spans(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word (n+1 values)."""
    inside = kind[data]
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... of every span, one after another."""
    total = np.cumsum(lengths)
    size = int(total[-1]) if len(total) else 0
    return np.arange(size) + np.repeat(starts - (total - lengths), lengths)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes; spans must not be empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    at = within(np.zeros(len(starts), np.int64), lengths)
    value = _BYTE[data[at + np.repeat(starts, lengths)]]
    value *= powers(int(lengths.max()))[at]
    return mix(np.add.reduceat(value, begin) + lengths.astype(np.uint64) * _M2)


def grams(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k consecutive words that stay in one text, and their first words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    factors = powers(k + 1)[1:]
    for i in range(k):
        total += words[i : i + n] * factors[i]
    fits = np.ones(n, dtype=bool)
    for i in range(1, k):
        cut = first[1:-1] - i
        fits[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(fits)
    return mix(total[at]), at


def per_text(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bounds in ``at`` (sorted word numbers) of each text (n+1 values)."""
    return np.searchsorted(at, first)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
