"""Vectorised helpers for texts in Arrow batches: bounded slices of a task's
rows, ragged arrays, bit filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of about ``max_bytes`` of text; a
    longer text is a table of its own."""
    held, size = [], 0
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        s = 0
        while s < len(sizes):
            fits = np.cumsum(sizes[s:]) <= max_bytes - size
            n = int(fits.sum())
            if n == 0 and not held:
                n = 1
            if n:
                held.append(b.slice(s, n))
                size += int(sizes[s:s + n].sum())
                s += n
            if s < len(sizes) or size >= max_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``[s, s + 1, ...]`` of each start and length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values[at[i]:at[i + 1]]`` for each ``i``."""
    total = offsets(values)
    return total[at[1:]] - total[at[:-1]]


def lists(at: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), values)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C15))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of each hash in a filter of ``bits`` (a power of two)."""
    mask = np.uint64(bits - 1)
    return [hashes & mask, (hashes >> np.uint64(20)) & mask, mix(hashes, hashes) & mask]


def holds(packed: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold (those put in always)."""
    out = np.ones(len(hashes), bool)
    for p in positions(hashes, bits):
        out &= (packed[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
