"""Words of Arrow text columns as numpy arrays: spans, 64-bit hashes and windows, a whole batch at a time.

A word is a run of bytes other than space and 0x09-0x0D. Nulls are empty texts. Work goes in chunks
of whole documents of about a megabyte, so memory follows the chunk and the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240607)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, CHUNK_BYTES), _powers(_INVERSE, CHUNK_BYTES)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values with well spread bits, another one for each seed."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each span of bytes; spans are ordered and do not overlap."""
    global _UP, _DOWN
    out = np.empty(len(start), np.uint64)
    codes = _BYTE_CODES[_LOWER] if lower else _BYTE_CODES
    at = 0
    while at < len(start):
        upto = max(int(np.searchsorted(end, start[at] + CHUNK_BYTES, "right")), at + 1)
        first, n = int(start[at]), int(end[upto - 1] - start[at])
        up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_BASE, n), _powers(_INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[data[first : first + n]] * up[:n], out=sums[1:])
        s, e = start[at:upto] - first, end[at:upto] - first
        out[at:upto] = mix((sums[e] - sums[s]) * down[s])
        at = upto
    return out


@dataclass
class Chunk:
    """Some whole rows of a text column. row_at: byte offsets of the rows, one more than rows."""

    first_row: int
    data: np.ndarray
    row_at: np.ndarray
    separators: np.ndarray = field(default_factory=lambda: SEPARATOR)

    @property
    def rows(self) -> int:
        return len(self.row_at) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.row_at[row] : self.row_at[row + 1]].tobytes()

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets at which words start and end."""
        inside = ~self.separators[self.data]
        border = np.zeros(len(self.data) + 1, bool)
        border[self.row_at] = True
        before = border[:-1].copy()
        before[1:] |= ~inside[:-1]
        after = border[1:].copy()
        after[:-1] |= ~inside[1:]
        return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1

    @cached_property
    def word_at(self) -> np.ndarray:
        """Index of each row's first word, and the number of words."""
        return np.searchsorted(self.spans[0], self.row_at)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_at)

    @cached_property
    def word_row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.n_words)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self.data, *self.spans, lower)

    @cached_property
    def points(self) -> np.ndarray:
        """Code points before each byte offset."""
        out = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of each run of n words within a row."""
        last = len(hashes) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(self.word_row[:last] == self.word_row[n - 1 :])
        total = hashes[:last] * _STEPS[0]
        for j in range(1, n):
            total += hashes[j : last + j] * _STEPS[j % len(_STEPS)]
        return start, mix(total[start], n)


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES, separators: np.ndarray = SEPARATOR) -> Iterator[Chunk]:
    """The column cut into chunks of whole rows of about `size` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        upto = min(max(int(np.searchsorted(at, at[row] + size, "right")) - 1, row + 1), row + 60_000, len(column))
        yield Chunk(row, data[at[row] : at[upto]], at[row : upto + 1] - at[row], separators)
        row = upto


def by_row(values: np.ndarray, row_at: np.ndarray, ufunc: np.ufunc = np.add) -> np.ndarray:
    """`ufunc` reduced over values[row_at[i]:row_at[i + 1]] of each row; 0 for a row without values."""
    out = np.zeros(len(row_at) - 1, values.dtype)
    full = np.flatnonzero(np.diff(row_at) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, row_at[full])
    return out


def group_by_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Order that sorts by row, then hash, then position. Rows number below 65,536."""
    order = np.argsort(hashes, kind="stable")
    return order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
