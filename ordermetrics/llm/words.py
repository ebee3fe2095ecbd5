"""Words, hashes and Arrow slices shared by the operators on texts.

Texts stay in Arrow's buffers: a slice of a batch is one byte array with row offsets, words
are (start, end) positions in it, and everything below works on whole slices at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# Byte classes: words end at ASCII white space, whatever the bytes between are.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# Letters a-z, digits and every non-ASCII byte.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every bit."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)

        def grow(b):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        _powers[base] = have = grow(base), grow(pow(base, -1, 1 << 64))
    return have


class Ranges:
    """Hashes of any range of a sequence of 64-bit values, from one pass over it."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start], 1)


def strings(batch: pa.RecordBatch, column: str) -> pa.Array:
    return pc.fill_null(batch.column(column), "").cast(pa.large_string())


def slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of at most ``size`` bytes, or of one longer row."""
    array = strings(batch, column)
    if not len(array):
        return
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(array):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + size, "right")) - 1)
        yield row, stop, data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


def spans(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that ``table`` marks."""
    return runs(table[data], offsets)


def runs(marked: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal marked run; runs end with their row."""
    inside = np.zeros(len(marked) + 2, bool)
    inside[1:-1] = marked
    cuts = offsets[1:-1]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = cuts[(cuts > 0) & (cuts < len(marked))]
    first[cuts] = inside[1:-1][cuts]
    last[cuts - 1] = inside[1:-1][cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets[1:], start, "right")


def word_hashes(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0],
) -> np.ndarray:
    """A 64-bit hash of each word; long texts are taken in parts that end at words."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + SLICE_BYTES, "right")))
        low, high = start[at], end[stop - 1]
        values = data[low:high].astype(np.uint64)
        values += np.uint64(1)
        out[at:stop] = Ranges(values, base)(start[at:stop] - low, end[at:stop] - low)
        at = stop
    return out


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each row's words, for words in row order."""
    return np.searchsorted(rows, np.arange(n + 1))
