"""Vectorised tokens of whole texts, straight from Arrow buffers.

Words are maximal runs of bytes that belong to a class; a word's 64-bit hash is a sum of random byte values
times powers of an odd constant, mixed. No Python object is made per word. Null texts count as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_STEP = int(_rng.integers(1, 2**62)) * 2 + 1
_POWERS = np.cumprod(np.full(256, _STEP, dtype=np.uint64))

WORD = np.ones(256, dtype=bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Stands for the end of a text; no word has it but by a 64-bit collision.
END = mix(np.array([0x5DEECE66D], dtype=np.uint64))[0]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n + 1 offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if large else pa.binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), where


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of member bytes, and where each row's runs begin (n + 1)."""
    low, high = int(offsets[0]), int(offsets[-1])
    inside = member[data[low:high]]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.empty(len(inside), dtype=bool)  # a row or a run begins here
    edge[0], edge[1:] = True, inside[1:] != inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < high] - low
    edge[firsts] = True
    cuts = np.flatnonzero(edge)
    lengths = np.diff(cuts, append=len(inside))
    keep = inside[cuts]
    starts, lengths = cuts[keep] + low, lengths[keep]
    return starts, lengths, np.searchsorted(starts, offsets)


def powers(n: int) -> np.ndarray:
    return _POWERS[:n] if n <= len(_POWERS) else np.cumprod(np.full(n, _STEP, dtype=np.uint64))


def hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each run; fold: with A-Z lower-cased."""
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.cumsum(lengths)
    inner = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    value = (_LOWER if fold else _BYTE)[data[np.repeat(starts, lengths) + inner]]
    value *= powers(int(lengths.max()))[inner]
    return mix(np.add.reduceat(value, ends - lengths))


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and where each row's words begin (n + 1)."""
    starts, lengths, at = runs(data, offsets, member)
    return hashes(data, starts, lengths), at


_SALT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def shingles(h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows and where each row's begin; a row of fewer words has its whole sequence as one."""
    n = np.diff(at)
    many = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    to = np.concatenate(([0], np.cumsum(many)))
    first = np.repeat(at[:-1] - to[:-1], many) + np.arange(to[-1])  # where each window begins in h
    value = np.zeros(len(first), np.uint64)
    padded = np.concatenate((h, np.zeros(k, np.uint64)))
    short = np.repeat(n < k, many)
    left = np.repeat(n, many)
    for j in range(k):
        part = padded[first + j] * _SALT[j]
        if short.any():
            part[short & (left <= j)] = U(0)
        value += part
    if short.any():
        value[short] += left[short].astype(np.uint64) * _SALT[k]
    return mix(value), to


def lean(run: Callable) -> Callable:
    """run over a task's batches; afterwards freed memory goes back to the system, since Spark keeps its Python
    workers and the next task may need the memory for something else."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
