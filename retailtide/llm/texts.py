"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A batch of texts is never turned into Python strings: words are byte ranges, and a word, a line or
a window of words is named by a 64-bit hash that is the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are held as arrays at once; one longer text makes a slice of its own.
SLICE_BYTES = 1_000_000

#: ASCII white space, which separates words.
SPACES = b" \t\n\v\f\r"

_U64 = np.uint64
_seeded = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODES = _seeded.integers(1, 2**63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
_STEP = _U64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _STEP, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; the ranges are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = ranges(starts, sizes)
    codes = _BYTE_CODES[data[at]] * powers(int(sizes.max()))[at - np.repeat(starts, sizes)]
    return mix(np.add.reduceat(codes, first) + sizes.astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` word hashes, by position of its first word."""
    count = max(0, len(words) - width + 1)
    out = np.zeros(count, np.uint64)
    for j in range(width):
        out = out * _STEP + words[j : j + count]
    return mix(out)


def runs(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``counts``, one after another."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``first`` to ``first + counts - 1`` of each range, one range after another."""
    if not counts.all():
        some = counts > 0
        first, counts = first[some], counts[some]
    if not len(counts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    out = np.ones(int(ends[-1]), np.int64)
    out[0] = first[0]
    out[ends[:-1]] = first[1:] - (first[:-1] + counts[:-1] - 1)
    return np.cumsum(out, out=out)


class Texts:
    """A slice of a text column: its bytes, the words in them, and each text's first word."""

    def __init__(self, column: pa.Array, lower: bool = False):
        if column.null_count:
            column = column.fill_null("")
        if len(column):
            _, offsets, data = column.buffers()
            kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
            at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
            raw = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
            self.offsets = at.astype(np.int64) - int(at[0])
        else:
            raw, self.offsets = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.data = _LOWER[raw] if lower else raw
        self.gap = _IS_SPACE[raw]
        begins = np.zeros(len(raw) + 1, bool)
        begins[self.offsets] = True
        word = ~self.gap
        after_gap = np.concatenate([[True], self.gap[:-1]]) if len(raw) else self.gap
        before_gap = np.concatenate([self.gap[1:], [True]]) if len(raw) else self.gap
        self.starts = np.flatnonzero(word & (after_gap | begins[:-1]))
        self.ends = np.flatnonzero(word & (before_gap | begins[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.n_words = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.data, self.starts, self.ends)

    def count_bytes(self, marked: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.concatenate([[0], np.cumsum(marked)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def count_words(self, marked: np.ndarray) -> np.ndarray:
        """How many marked words each text has."""
        total = np.concatenate([[0], np.cumsum(marked)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def windows(self, width: int) -> np.ndarray:
        """Positions of the words at which a window of that many words of one text begins."""
        counts = np.maximum(self.n_words - width + 1, 0)
        return np.repeat(self.first[:-1], counts) + runs(counts)


#: What a worker keeps for further tasks of one operator, by the functions that let it go.
_kept: list[Callable[[], bool]] = []


def keeps(let_go: Callable[[], bool]) -> None:
    """Name a function that lets go what a worker keeps, and tells whether there was anything."""
    if let_go not in _kept:
        _kept.append(let_go)


def release() -> None:
    """Let go what a worker keeps, and give the memory back to the system."""
    if any([let_go() for let_go in _kept]):
        give_back()


def give_back() -> None:
    """Give memory that is free by now back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(
    batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, keep: bool = False
) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of text, or one row.

    Without ``keep`` what tasks of another operator have kept in this worker is let go first.
    """
    if not keep:
        release()
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64
    )
    start, total = 0, np.cumsum(sizes)
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()
