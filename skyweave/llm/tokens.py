"""Words and shingles of whole Arrow string columns, by array arithmetic on their bytes.

A word is a longest run of bytes other than space and the controls 9 to 13. All functions take a
column without nulls; a chunk of rows is handled at a time so that memory follows the chunk, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(9, 14)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def odd_numbers(seed: int, count: int) -> np.ndarray:
    """The same random odd 64-bit numbers everywhere."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, count, dtype=np.uint64) | _U(1)


@dataclass
class Words:
    row: np.ndarray
    """The row each word stands in."""
    start: np.ndarray
    end: np.ndarray
    """Byte range of each word in ``data``."""
    data: np.ndarray
    offsets: np.ndarray
    """Byte range of row i: offsets[i] to offsets[i + 1]."""

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, made for about ``CHUNK_BYTES`` at a time however long a text is."""
        lengths = self.end - self.start
        out = np.empty(len(lengths), dtype=np.uint64)
        if not len(lengths):
            return out
        powers = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        codes = mix(np.arange(1, 257, dtype=np.uint64))
        through = np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            to = max(at + 1, int(np.searchsorted(through, through[at] + CHUNK_BYTES)))
            own = lengths[at:to]
            begin = np.cumsum(own) - own
            inner = np.arange(int(own.sum()), dtype=np.int64) - np.repeat(begin, own)
            terms = codes[self.data[np.repeat(self.start[at:to], own) + inner]] * powers[inner]
            out[at:to] = np.add.reduceat(terms, begin)
            at = to
        return mix(out ^ (lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows with about ``size`` bytes, each with the number of its first row."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, column.slice(at, to - at)
        at = to


def words(column: pa.Array, lower: bool = False) -> Words:
    """The words of a chunk (``large_string`` without nulls); ``lower`` maps A-Z to a-z first."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, end, data, offsets)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every row, sorted within the row, and the row of each.

    Rows with fewer words than ``size`` have their whole sequence as the only shingle; rows without words have none.
    """
    h, row = found.hashes(), found.row
    if not len(h):
        return h, row
    counts = found.counts()
    first = np.cumsum(counts) - counts
    span = np.minimum(counts[row], size)
    at = np.flatnonzero(np.arange(len(h)) + span - first[row] <= counts[row])
    factors = odd_numbers(77, size)
    value = span[at].astype(np.uint64) * _U(0xA0761D6478BD642F)
    for j in range(size):
        with_word = span[at] > j
        value[with_word] += h[at[with_word] + j] * factors[j]
    value, row = mix(value), row[at]
    bounds = np.flatnonzero(np.diff(row)) + 1
    for part in np.split(value, bounds):
        part.sort()
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])))
    return value[fresh], row[fresh]
