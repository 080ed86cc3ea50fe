"""Words and shingles of whole texts as numpy arrays, for use inside Arrow batches.

A word is a run of bytes other than blank and \\x09-\\x0D, as its 64-bit hash. All functions work on the
UTF-8 bytes of an Arrow column in slices of about ``SLICE_BYTES``, so memory does not grow with the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` with the memory of its large arrays given back to the system at its end: Spark keeps the process for
    the tasks of later stages, and what an allocator holds would add up with theirs."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux
            if trim:
                trim(0)

    return wrapped


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, one per word
    first: np.ndarray  # words first[d] to first[d + 1] belong to text d
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    data: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Keeps the powers between slices."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def spans(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each byte span; equal bytes give equal hashes wherever they stand."""
        if len(raw) > len(self.up):
            n = max(len(raw), SLICE_BYTES * 2)
            self.up, self.down = powers(n, self.base), powers(n, self.inverse)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=total[1:])
        return mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))

    def words(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = LOWER, gap: np.ndarray = GAP) -> Words:
        """Words of the texts between ``offsets``; ``table`` maps bytes first, ``gap`` tells separators."""
        data = table[raw[offsets[0] : offsets[-1]]]
        bounds = offsets - offsets[0]
        blank = gap[data]
        border = np.zeros(len(data) + 1, bool)
        border[bounds] = True
        inside = np.concatenate(([False], ~blank, [False]))
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
        return Words(self.spans(data, start, end), np.searchsorted(start, bounds), start, end, data)


def shingle_hashes(words: Words, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending; fewer than ``size`` words make one shingle."""
    w, n = words.hashes, len(words.hashes)
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size if n >= size else 0):
        rolled = (rolled + w[k : n - size + 1 + k]) * np.uint64(BASE)
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            value = np.uint64(b - a)
            for h in w[a:b]:
                value = mix((np.array([value]) + h) * np.uint64(BASE))[0]
            out.append(np.array([value], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
