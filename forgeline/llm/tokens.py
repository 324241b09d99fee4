"""Vectorised whitespace tokens over Arrow string columns.

A token is a maximal run of characters outside space and U+0009..U+000D, with
A-Z lower-cased.  Tokens are represented by a 64-bit hash, computed for a whole
block of rows at once from prefix sums, so that no Python code runs per row or
per token."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"n": 0}
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INV)):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _powers[name] = np.cumprod(t, dtype=np.uint64)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row offsets, UTF-8 bytes) of runs of rows of about
    BLOCK_BYTES; a NULL row has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first:last + 1]
        yield first, part - part[0], data[part[0]:part[-1]]
        first = last


def hash_spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every span of a byte array, the same wherever the span stands."""
    up, down = _power_tables(len(values))
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((values.astype(np.uint64) + U(1)) * up[:len(values)], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return mix(h ^ ((end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93)))


def runs(offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal runs of one non-zero kind of byte."""
    edge = np.zeros(len(kind) + 1, dtype=bool)
    edge[offsets] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    some = kind[start] > 0
    start, end = start[some], end[some]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token of one block."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start, end, row = runs(offsets, (~_SPACE[data]).view(np.uint8))
    return hash_spans(_LOWER[data], start, end), row


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``n`` tokens within a row."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.full(m, n, dtype=np.uint64)
    for i in range(n):
        acc = mix(acc * U(0xD1342543DE82EF95) + h[i:i + m])
    inside = row[:m] == row[n - 1:]
    return acc[inside], row[:m][inside]
