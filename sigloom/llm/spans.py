"""Words of whole Arrow text columns as byte spans and 64-bit hashes, without a Python loop over words.

A chunk is the UTF-8 buffer of some rows with its row offsets. Words are found with a table over byte
values, hashed with a polynomial over random byte codes (running sums, so the cost doesn't depend on
the length of words) and combined into hashes of n consecutive words of one row.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 4 << 20
SEGMENT_BYTES = 1 << 18
LONG_WORD = 1 << 20

_RANDOM = np.random.default_rng(20240229)
CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C13)
ROLL = np.uint64(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes of words: everything but ASCII white space, and (after lower-casing) letters, digits and all of non-ASCII
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
WORDLIKE = np.zeros(256, bool)
WORDLIKE[0x30:0x3A] = WORDLIKE[0x61:0x7B] = WORDLIKE[0x80:] = True


class Words(NamedTuple):
    """start and end bytes of words; `first[r]` is the index of row r's first word, `first[rows]` their number."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(table, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Slices of a batch or table with at most `limit` bytes of text, or one row: (slice, bytes, offsets)."""
    data, at = column_bytes(table.column(column))
    row, rows = 0, len(at) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield table.slice(row, to - row), data[at[row] : at[to]], at[row : to + 1] - at[row]
        row = to
    give_back()


def give_back() -> None:
    """Returns freed memory to the machine: a worker process serves many tasks, and its peak would stay with it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Longest stretches of bytes that `table` marks, inside rows."""
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    inside = table[data]
    edge = np.zeros(n + 1, bool)
    edge[1:n] = inside[1:] != inside[:-1]
    edge[0], edge[n] = inside[0], inside[-1]
    start = np.flatnonzero(edge[:-1] & inside)
    end = np.flatnonzero(edge[1:] & inside) + 1
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < n)])
    cut = cut[inside[cut] & inside[cut - 1]]  # a word that runs across two rows is two words
    if len(cut):
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return Words(start, end, np.searchsorted(start, offsets).astype(np.int64))


_C = ctypes.CDLL(None)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """STEP ** 0 .. n and more, modulo 2 ** 64."""
    global _powers
    if len(_powers) <= n:
        size = max(n + 1, SEGMENT_BYTES)
        _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, STEP)]))
    return _powers


INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def inverses(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) <= n:
        size = max(n + 1, SEGMENT_BYTES)
        _inverses = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, INVERSE)]))
    return _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits, in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def ranges(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial over codes[start:end], for each range; ascending starts, counted from the first of them."""
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * inverses(len(codes))[: len(codes)], out=total[1:])
    return (total[end] - total[start]) * powers(len(codes))[start]


def hashes(data: np.ndarray, found: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(found.start), np.uint64)
    i, n = 0, len(out)
    size = found.end - found.start
    while i < n:
        base = found.start[i]
        j = max(i + 1, int(np.searchsorted(found.end, base + SEGMENT_BYTES, "right")))
        if size[i] > LONG_WORD:
            out[i] = xxhash.xxh64_intdigest(data[found.start[i] : found.end[i]].tobytes())
            i += 1
            continue
        if j > i + 1 and size[i:j].max() > LONG_WORD:
            j = i + int(np.argmax(size[i:j] > LONG_WORD))
        out[i:j] = ranges(CODES[data[base : found.end[j - 1]]], found.start[i:j] - base, found.end[i:j] - base)
        i = j
    out += size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(out)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, rows not regarded; len(h) - n + 1 of them."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out *= ROLL
        out += h[k : k + m]
    return mix(out)


def whole(row: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words from each position on are of one row."""
    return row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)


def sets(h: np.ndarray, found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-word shingles of each row: (hashes, offsets). A row of 1 to n - 1 words has one shingle, all its words."""
    rows = len(found.first) - 1
    row = found.row
    ok = whole(row, n)
    g, of = grams(h, n)[ok], row[: len(ok)][ok]
    count = np.diff(found.first)
    for r in np.flatnonzero((count > 0) & (count < n)):
        x = h[found.first[r] : found.first[r + 1]]
        one = np.array([count[r]], np.uint64)
        for y in x:
            one = one * ROLL + y
        g, of = np.append(g, mix(one)), np.append(of, r)
    order = np.lexsort((g, of))
    g, of = g[order], of[order]
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (of[1:] != of[:-1])
        g, of = g[new], of[new]
    return g, np.searchsorted(of, np.arange(rows + 1)).astype(np.int64)


def join_words(data: np.ndarray, found: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each row joined by one space: (bytes, offsets)."""
    kept = np.flatnonzero(keep)
    first = np.searchsorted(kept, found.first)
    lead = np.ones(len(kept), np.int64)
    lead[first[:-1][first[:-1] < first[1:]]] = 0
    size = found.end[kept] - found.start[kept] + lead
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    source = np.arange(at[-1]) + np.repeat(found.start[kept] - lead - at[:-1], size)
    out = data[source] if len(source) else np.zeros(0, np.uint8)
    out[at[:-1][lead == 1]] = 0x20
    return out, at[first]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A text column from bytes and offsets."""
    column = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return column.cast(pa.string()) if offsets[-1] < 2**31 else column


def integers(column, null: int) -> np.ndarray:
    """A column of whole numbers, `null` for nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)
