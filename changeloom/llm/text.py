"""Words of Arrow text columns as flat numpy arrays, for use inside Spark tasks.

A word is a maximal run of bytes other than ``WHITE``, unchanged. Null texts have no
words. Everything here works on one Arrow batch of one task; pieces of a few megabytes
keep memory bounded, and a longer document is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

#: White space: tab, line feed, vertical tab, form feed, carriage return, space.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_BYTES = 1 << 20

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = np.asarray(x, _U).copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 20)) * _U(0x9E3779B97F4A7C15))


_BYTE = seeds(256, 1)


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64; they grow on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            for name, value in (("up", self.base), ("down", self.inverse)):
                factors = np.full(size, value, _U)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(0xD1342543DE82EF95), _Powers(0xA3EC647659359ACD)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte span; equal spans get equal values wherever they stand."""
    up, down = _BYTES.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(_U)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * _U(0x9E3779B97F4A7C15))


def window_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the word hashes from each start to its end."""
    up, down = _WORDS.to(len(words) + 1)
    sums = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


@dataclass
class Texts:
    """Some rows of a text column: their bytes, where each row starts, and their words."""

    data: np.ndarray
    offsets: np.ndarray
    rows: slice

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def _spans(self) -> tuple[np.ndarray, np.ndarray]:
        white, n = _IS_WHITE[self.data], len(self.data)
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = white[:-1], white[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[edges] = True
        after[edges - 1] = True
        return np.flatnonzero(~white & before), np.flatnonzero(~white & after) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._spans[0]

    @property
    def ends(self) -> np.ndarray:
        return self._spans[1]

    @cached_property
    def words(self) -> np.ndarray:
        """The hash of every word."""
        return span_hashes(self.data, self.starts, self.ends)

    @cached_property
    def bounds(self) -> np.ndarray:
        """Row r has words ``bounds[r]`` to ``bounds[r + 1]``."""
        return np.searchsorted(self.starts, self.offsets)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def row(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and row of each run of ``width`` words within a row."""
        starts = np.arange(len(self.words) - width + 1 if len(self.words) >= width else 0)
        starts = starts[starts + width <= self.bounds[1:][self.row[starts]]]
        return starts, starts + width, self.row[starts]

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every run of ``width`` words; a row with fewer words has one
        run of all its words, and a row without words has none."""
        starts, ends, row = self.windows(width)
        short = np.flatnonzero((self.counts > 0) & (self.counts < width))
        starts = np.concatenate([starts, self.bounds[short]])
        ends = np.concatenate([ends, self.bounds[short + 1]])
        return np.concatenate([row, short]), window_hashes(self.words, starts, ends)

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[Texts]:
    """The rows of a text column in order, about ``most`` bytes at a time."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        start, end = offsets[first], offsets[last]
        yield Texts(data[start:end], offsets[first : last + 1] - start, slice(first, last))
        first = last


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Flat values as one list for each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.LargeListArray.from_arrays(offsets, pa.array(values, kind)).cast(pa.list_(kind))
