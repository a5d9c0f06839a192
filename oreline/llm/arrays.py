"""Array helpers for Python tasks: Arrow strings to words, hashes and shingles, in blocks of bounded size.

A text is never cut: a block holds whole texts and is larger than ``BLOCK`` only for a single longer text.
"""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20                                  # bytes of text handled at a time
_SPACES = (9, 10, 11, 12, 13, 32)                # the white space of [^\x20\x09-\x0D]+
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs give equal outputs on every machine."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers or more of the base and of its inverse modulo 2**64; a worker keeps the longest tables only."""
    if len(_POWERS[0]) < n:
        size = max(1 << 16, n + n // 8)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[i] = np.multiply.accumulate(table)
    return _POWERS[0], _POWERS[1]


CACHES = []                                      # functions that empty what a worker keeps between texts


def forget_powers() -> None:
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


CACHES.append(forget_powers)


def lean(run):
    """``run`` over the batches of a partition; the worker then gives its memory back.

    Spark keeps Python workers for later tasks. An idle one should not hold the tables and freed blocks of a task that is over.
    """
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for empty in CACHES:
                empty()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):    # another C library
                pass
    return wrapped


@functools.lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    values = mix(codes + np.uint64(0x1234567))
    values[list(_SPACES)] = 0
    return values


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(_SPACES)] = True


def strings(column: pa.Array) -> pa.Array:
    """The column as plain strings, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array without nulls."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def blocks(texts: pa.Array, size: int = BLOCK):
    """Yield (first row, texts) with about ``size`` bytes each."""
    _, at = raw(texts)
    row, rows = 0, len(texts)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, texts.slice(row, min(end, rows) - row)
        row = min(end, rows)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: ``starts``/``ends`` (bytes), ``at`` (first word of each row)."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        n = len(self.data)
        inside = ~IS_SPACE[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[:-1][self.offsets[:-1] < n]
        first[cuts] = inside[cuts]
        before = cuts[cuts > 0] - 1
        last[before] = inside[before]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` folds A-Z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data))
        values = _byte_values(lower)[self.data]
        values *= up[:len(values)]
        return mix(np.add.reduceat(values, self.starts) * down[self.starts])


def shingles(hashes: np.ndarray, at: np.ndarray, width: int, short: bool = False):
    """(shingle hashes, their first word, first shingle of each row).

    A row of w words has w - width + 1 shingles; with ``short`` a row of 1..width-1 words has its whole
    sequence as one.
    """
    counts = np.diff(at)
    number = np.maximum(counts - width + 1, 0)
    if short:
        number[(counts > 0) & (counts < width)] = 1
    begin = np.concatenate([[0], np.cumsum(number)])
    row = np.repeat(np.arange(len(counts)), number)
    word = np.arange(begin[-1]) - begin[row] + at[row]
    used = np.minimum(counts, width)[row]
    out = np.zeros(len(word), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for j in range(width):
        step = out * np.uint64(0xD6E8FEB86659FD93) + padded[word + j]
        out = np.where(j < used, step, out) if short else step
    return mix(out + used.astype(np.uint64)), word, begin


def arrow_rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name].cast(f.type) for f in schema], schema=schema)
