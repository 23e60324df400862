"""Whole columns of texts as bytes, words and 64-bit hashes in numpy: helpers that run inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
#: Bytes of text worked on at once inside a task. A longer text is one piece of its own; nothing is cut.
PIECE = 1 << 18


def give_back() -> None:
    """Hand freed memory back to the system: idle Python workers would hold it while other stages need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without this call
        pass


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches one by one, giving freed memory back after each and at the end of the task."""
    for batch in batches:
        yield batch
        del batch
        give_back()
    give_back()


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def splitmix(n: int, seed: int) -> np.ndarray:
    """n well-mixed 64-bit numbers from a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & MASK))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


_BYTE = splitmix(256, 11)
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, dtype=np.uint64)
_backs = np.ones(1, dtype=np.uint64)


def _ladder(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & MASK, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def ladders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, at least."""
    global _powers, _backs
    if len(_powers) < n:
        size = max(n, PIECE + 1)
        _powers, _backs = _ladder(_BASE, size), _ladder(_BACK, size)
    return _powers, _backs


@dataclass
class Piece:
    """Neighbouring rows of a batch: rows first..last-1, their bytes, and where each row begins and ends in them."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """Rows of a string column in pieces of about ``size`` bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.array(column, type=pa.large_string()) if column.type == pa.null() else column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(len(column), max(first + 1, last))
        yield Piece(first, last, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """start and end byte of each word of a piece, and for each row the span of its words."""

    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray


def find_words(piece: Piece, space: np.ndarray = SPACE) -> Words:
    """Words are the runs of bytes outside ``space``, 0x20 and 0x09-0x0D if not given; a word ends with its row."""
    n = len(piece.data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(len(piece.bounds), dtype=np.int64))
    inside = ~space[piece.data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[piece.bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(start, end, np.searchsorted(start, piece.bounds))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, by one running polynomial."""
    n = len(data)
    if not n or not len(start):
        return np.zeros(len(start), dtype=np.uint64)
    powers, backs = ladders(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * powers[:n], out=run[1:])
        return mix((run[end] - run[start]) * backs[start] + (end - start).astype(np.uint64))


def word_hashes(piece: Piece, words: Words) -> np.ndarray:
    """Hashes of the words with A-Z lower-cased."""
    return span_hashes(LOWER[piece.data], words.start, words.end)


_STEP = splitmix(64, 23) | np.uint64(1)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted set of hashes of its ``width``-word shingles; fewer words make one shingle of all."""
    for piece in pieces(column):
        words = find_words(piece)
        h = word_hashes(piece, words)
        with np.errstate(over="ignore"):
            full = np.zeros(max(0, len(h) - width + 1), dtype=np.uint64)
            for k in range(width if len(full) else 0):
                full += h[k: k + len(full)] * _STEP[k]
            full = mix(full)
            for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
                if b - a >= width:
                    yield np.unique(full[a: b - width + 1])
                elif b > a:
                    short = (h[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                    yield mix(np.array([short], dtype=np.uint64))
                else:
                    yield np.zeros(0, dtype=np.uint64)
