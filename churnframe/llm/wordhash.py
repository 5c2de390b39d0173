"""Vectorised word and shingle hashing over Arrow string buffers.

Works inside Arrow tasks on one record batch at a time.  A word is a maximal
run of bytes outside ``\\x20 \\x09-\\x0D``; in UTF-8 no byte of a longer
character falls in that set, so bytes and code points give the same words.
Hashes are 64-bit and depend only on the text and the seed, never on the
process, so every executor computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text hashed at a time (bounds the working arrays; longer
#: documents are cut between words)
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(cls, name, np.multiply.accumulate(a))
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (bijective), so that close inputs spread."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (int64, length rows + 1) of a string column.
    Null rows have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows): consecutive parts of at most ``limit`` bytes of text,
    or one row, so that working arrays stay small whatever the batch."""
    _, offsets = text_buffers(column)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), len(column))
        yield at, column.slice(at, stop - at)
        at = stop


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a row's end also ends a word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[raw]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    begin[edge] = word[edge]
    end = word.copy()
    end[:-1] &= ~word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = word[last]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               table: np.ndarray = _TABLE) -> np.ndarray:
    """64-bit hash of every span of bytes: a polynomial in a fixed odd base
    modulo 2**64, read off one running sum per block."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        lo = starts[k]
        stop = int(np.searchsorted(ends, lo + BLOCK_BYTES, side="right"))
        stop = max(stop, k + 1)
        hi = ends[stop - 1]
        up, down = _Powers.get(int(hi - lo) + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[raw[lo:hi]] * up[:hi - lo], out=run[1:])
        s, e = starts[k:stop] - lo, ends[k:stop] - lo
        out[k:stop] = mix((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64))
        k = stop
    return out


def row_word_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each row (length rows + 1)."""
    return np.searchsorted(starts, offsets, side="left")


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in row order, and each row's first word index."""
    raw, offsets = text_buffers(column)
    if lower:
        raw = _LOWER[raw]
    starts, ends = word_spans(raw, offsets)
    return hash_spans(raw, starts, ends), row_word_bounds(starts, offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles of one row's word hashes; a row with
    1 to ``k - 1`` words has one shingle, the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        h = (h * _BASE + words[j:n - width + 1 + j]) * np.uint64(0xD1342543DE82EF95)
    return mix(h)


def rows_shingles(column: pa.Array, k: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    words, bounds = word_hashes(column, lower)
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield np.unique(shingle_hashes(words[a:b], k))
