"""Words, lines and their hashes for whole columns of text at once, on UTF-8 bytes.

A text column arrives as one byte buffer with row offsets. Every value here is found with
array arithmetic over that buffer, so the cost per byte is a few memory passes and no
Python object is made per word.

Hashes are 64 bits: the sum of table[byte] * BASE**position (wrapping), read off a running
sum, shifted to position 0 by BASE's inverse, and mixed. Equal byte strings have equal
hashes everywhere, on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Rows are worked on together up to this many bytes (a longer row is worked on alone).
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_TABLE = (_TABLE << _U(1)) | _U(1)

#: The white space of the word rule [^\x20\x09-\x0D]+.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), wrapping; kept for the usual chunk size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 2 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


class SpanHash:
    """Hashes of any spans of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * powers(_BASE, n), out=self._sum[1:])
        self._back = powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sum[ends] - self._sum[starts]) * self._back[starts]
        return mix(value + (ends - starts).astype(np.uint64) * _U(0xD1B54A32D192ED03))


@dataclass
class Chunk:
    """Some rows' texts: ``data`` is their bytes, row i has data[bounds[i]:bounds[i+1]]."""

    first: int
    bounds: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flags lie in each row."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


@dataclass
class Words:
    """Maximal runs without white space, in order; ``row`` is the chunk's row of each."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    #: Words before each row, and all words at the end.
    before: np.ndarray


def text_column(column: pa.Array) -> pa.Array:
    """The column as 64-bit-offset strings; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column in runs of whole rows."""
    column = text_column(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        own = bounds[row : end + 1]
        yield Chunk(row, own - own[0], bytes_[own[0] : own[-1]])
        row = end


def words(chunk: Chunk) -> Words:
    n = len(chunk.data)
    inside = np.ones(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(IS_SPACE[chunk.data], out=inside[1:-1])
    cut = np.zeros(n + 1, bool)
    cut[chunk.bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    row = chunk.row_of(starts)
    before = np.searchsorted(starts, chunk.bounds)
    return Words(starts, ends, row, before)


def ngram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive codes, whatever rows they lie in."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    m = len(codes) - n + 1
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total = total * _U(0x2545F4914F6CDD1D) + codes[k : k + m]
    return mix(total)


def whole_windows(before: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of n words that lie in one row."""
    counts = np.diff(before)
    total = int(before[-1])
    good = np.zeros(total + 1, np.int64)
    has = counts >= n
    np.add.at(good, before[:-1][has], 1)
    np.add.at(good, (before[1:] - n + 1)[has], -1)
    return np.flatnonzero(np.cumsum(good[:-1]) > 0)
