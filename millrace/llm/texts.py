"""Texts of an Arrow batch as one run of bytes, so that numpy sees all of them at once.

Texts are taken as UTF-8; a null is an empty text. Only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier of the prefix sums and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words between blanks: not space, tab, line feed, vertical tab, form feed, carriage return.
BLANKED = np.ones(256, dtype=bool)
BLANKED[[0x20, *range(0x09, 0x0E)]] = False

#: Words of 0-9, a-z and every byte beyond ASCII (upper case is gone by then).
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece hold at most ``most`` bytes, or are a single text."""
    for batch in batches:
        starts, ends, _ = spans(batch.column(column))
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def spans(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text starts and ends in the bytes, and the bytes."""
    array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    content = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    return at[:-1], at[1:], content


def words(
    content: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the number of words before each text (one entry more than texts)."""
    inside = table[content]
    edge = np.zeros(len(content) + 1, dtype=bool)
    edge[starts] = edge[ends] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return begin, end, np.searchsorted(begin, np.append(starts, len(content)))


@cache
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(size: int, base: int = BASE) -> np.ndarray:
    """base**i modulo 2**64; tables are kept by the next power of two."""
    return _powers(1 << max(10, int(size).bit_length()), base)[:size]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values[i] * BASE**i modulo 2**64, from 0 on."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values)), out=out[1:])
    return out


def hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[begin:end] that does not depend on where the run lies."""
    return mixed((sums[end] - sums[begin]) * powers(len(sums), INVERSE)[begin] + (end - begin).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each bit over all 64."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(content: np.ndarray, begin: np.ndarray, end: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of the bytes of each word; ``most`` bytes, or one longer word, at a time."""
    out, k = np.empty(len(begin), np.uint64), 0
    while k < len(begin):
        first = begin[k]
        last = max(k + 1, int(np.searchsorted(end, first + most, side="right")))
        sums = prefix_sums(content[first : end[last - 1]].astype(np.uint64) + np.uint64(1))
        out[k:last] = hashes(sums, begin[k:last] - first, end[k:last] - first)
        k = last
    return out


def running(counts: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def within(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (counts[i] numbers), one run after the other."""
    total = running(counts)
    return np.arange(total[-1]) + np.repeat(first - total[:-1], counts)
