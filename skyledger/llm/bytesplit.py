"""Vectorised word splitting and hashing over the bytes of an Arrow string column.

Used inside Arrow functions. Work goes in chunks of rows of about CHUNK bytes, so memory stays a small multiple of
that (or of the longest single text) whatever the batch or partition size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows end to end, and where each row begins (one more entry than rows). Null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, *columns: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows with about `size` bytes of text each; a longer text is a slice by itself."""
    size = size or CHUNK
    lengths = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends, first = np.cumsum(lengths), 0
    while first < len(lengths):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(first, last - first)
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and how many words the rows before each row have (one more entry than rows)."""
    inside = ~IS_WHITE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of byte ranges, all from one prefix sum of a polynomial in the bytes."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(data):
            self.powers, self.inverses = _powers(BASE, len(data)), _powers(BASE_INVERSE, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        hashed = mix((sums[ends] - sums[starts]) * self.inverses[starts])
        if len(self.powers) > 2 * CHUNK:  # one very long text: don't keep its tables
            self.powers = self.inverses = np.zeros(0, np.uint64)
        return hashed


def window_hashes(hashed: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbouring values, in order; rows are not looked at."""
    n = len(hashed) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashed[:n].copy()
    for j in range(1, width):
        out = out * np.uint64(BASE) + hashed[j : j + n]
    return mix(out)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def release() -> None:
    """Hand freed memory back to the system, Arrow's and, where the C library can (glibc), that of all else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def thrifty(function):
    """An Arrow function that hands freed memory back, at its end all of it: a worker waits for its next task beside the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        release()

    return run
