"""Words and their hashes over whole Arrow batches of texts, as numpy arrays.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage
return. In UTF-8 these six are single bytes that occur nowhere else, so words are found on the bytes.
``bytes.split()`` without arguments uses the same six.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The rule for a word, for use in SQL and regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Polynomial:
    """Hashes of slices of a sequence as differences of one running sum, modulo 2**64."""

    def __init__(self, seed: int):
        base = int(mix(np.array([seed], np.uint64))[0]) | 5
        self._base, self._inverse = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self._powers = self._inverses = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._powers[: len(values)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self._inverses[starts] + (ends - starts).astype(np.uint64))

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("_powers", self._base), ("_inverses", self._inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_BYTES, _WORDS, _WORDS_TOO = _Polynomial(11), _Polynomial(23), _Polynomial(37)
_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows of a string column, and where each row starts; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of parts of some bytes."""
    return _BYTES.between(_BYTES.sums(_CODES[data]), starts, ends)


def slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about ``size`` bytes of text each, at least one row, with their bytes and row starts."""
    if not batch.num_rows:
        return
    _, bounds = texts_of(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, "right")) - 1)
        part = batch.slice(lo, hi - lo)
        yield (part, *texts_of(part.column(column)))
        lo = hi


class Words:
    """The words of some texts: where each starts and ends in the bytes, the row it is in, and its hash."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.rows = len(bounds) - 1
        inside = ~_SPACE[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = bounds[:-1][bounds[:-1] < len(data)]
        before[cuts] = False
        after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(bounds, self.start, "right") - 1
        #: the first word of each row, with one entry more for the end
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))
        codes = _CODES[_LOWER[data] if lower else data]
        self.hash = _BYTES.between(_BYTES.sums(codes), self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int) -> np.ndarray:
        """The first words of all runs of ``size`` words within one row."""
        n = len(self) - size + 1
        return np.flatnonzero(self.row[:n] == self.row[size - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def window_hash(self, first: np.ndarray, size: int | np.ndarray, other: bool = False) -> np.ndarray:
        """A hash of the ``size`` words from each of ``first`` on; ``other`` gives a second, independent one."""
        family = _WORDS_TOO if other else _WORDS
        key = mix(self.hash ^ np.uint64(0x9E3779B97F4A7C15)) if other else self.hash
        return family.between(family.sums(key), first, first + size)
