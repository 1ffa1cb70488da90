"""Words of whole texts as numpy arrays, for Arrow batches inside Spark tasks.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All work is on the UTF-8 bytes of many texts at once, so no
Python object is made per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that begin a code point.
FIRST = (np.arange(256) & 0xC0) != 0x80
CHUNK_BYTES = 1 << 20

_STEP = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240817).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []  # filled in tasks alone


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1, 2 * len(_powers[0]) if _powers else 0)
        pair = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _powers[:] = pair
    return _powers[0], _powers[1]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end], from one prefix sum. values: 64-bit numbers."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of some texts: data (their bytes), starts and ends in it, first (each text's first word, and one end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~SPACES[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        edges = offsets[offsets < len(data)]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        edges = offsets[offsets > 0]
        after[edges - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTES[self.data], self.starts, self.ends)

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space behind each, and every word's start there (and one end): word w is out[s[w]:s[w + 1] - 1]."""
        sizes = self.ends - self.starts
        starts = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes + 1, out=starts[1:])
        out = np.full(starts[-1], 32, np.uint8)
        keep = ~SPACES[self.data]
        mask = np.ones(starts[-1], bool)
        mask[starts[1:] - 1] = False
        out[mask] = self.data[keep]
        return out, starts


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every run of inside bytes of some texts."""
    marks = np.zeros(len(data) + 1, bool)
    marks[:-1] = inside
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(marks & ~before)
    # a run ends where the next byte is outside, or another text's
    last = marks.copy()
    last[offsets] = False
    ends = np.flatnonzero(inside & ~last[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty; offsets begin at 0."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of consecutive rows: about size bytes, or one text if it is longer."""
    data, offsets = buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
