"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Words are runs of bytes other than space and ``\\x09``-``\\x0D``. Everything here runs
inside tasks on one slice of one Arrow batch, so memory is bounded by the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
LONG_WORD = 256
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = h * _A
    h ^= h >> np.uint64(29)
    h *= _B
    h ^= h >> np.uint64(32)
    return h


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``size`` bytes of text; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


@dataclass
class Texts:
    """Bytes of consecutive texts; ``offsets`` has one entry more than there are texts."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False) -> Texts:
        """A null text is an empty one."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        if not len(ends):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[ends[0]:ends[-1]]
        return cls(LOWER[raw] if lower else raw, ends - ends[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def total(self, marks: np.ndarray) -> np.ndarray:
        """Sum per text of a value per byte."""
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


@dataclass
class Words:
    """``starts`` and ``ends`` are byte positions; text i has the words bounds[i]:bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: Texts) -> Words:
        solid = ~SPACE[texts.data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        edges = texts.offsets[1:-1]
        inner = edges[(edges > 0) & (edges < len(solid))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
        starts = np.flatnonzero(first)
        return cls(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """64-bit hash of each word's bytes: eight bytes a step, all words together.

        Words of equal length up to eight bytes never collide; long ones are hashed one by one.
        """
        lengths = self.ends - self.starts
        h = mix(lengths.astype(np.uint64) + np.uint64(1))
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        active = np.flatnonzero(lengths <= LONG_WORD)
        at = 0
        while len(active):
            left = np.minimum(lengths[active] - at, 8)
            h[active] = mix(h[active] ^ (eight[self.starts[active] + at] & _MASKS[left]))
            at += 8
            active = active[lengths[active] > at]
        for i in np.flatnonzero(lengths > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(data[self.starts[i]:self.ends[i]].tobytes(), 7)
        return h


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0] + 1, ... of each run, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
