"""Shingle sets and fast similarity sketches of whole texts, in numpy over Arrow batches.

A sketch has ``BINS`` coordinates. In round ``i`` of the first ``BINS`` rounds every element of the set is
hashed to one bin with a value in [i, i + 1); bins keep their smallest value, so a bin that is filled takes
nothing from later rounds. ``BINS`` more rounds offer every element to one bin each, so every coordinate of a
non-empty set is filled. Two sets agree in a coordinate with probability equal to their similarity, and the
share of agreeing coordinates is concentrated around it as strongly as with independent samples, for small
sets too.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np

from .words import Words, mix

BINS = 256
_EMPTY = np.uint64(2**64 - 1)
_SEEDS = mix(np.arange(1000, 1000 + 2 * BINS, dtype=np.uint64))


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every row: their hashes, and where each row's begin (one entry more for the end).

    A row with fewer than ``size`` words has its whole word sequence as its one shingle, without words none.
    """
    first = words.windows(size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    row = np.concatenate([words.row[first], short])
    shingle = np.concatenate([
        words.window_hash(first, size),
        words.window_hash(words.first[short], words.counts[short]),
    ])
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    row, shingle = row[new], shingle[new]
    return shingle, np.searchsorted(row, np.arange(words.rows + 1))


def sketch(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of BINS coordinates for every set; those of empty sets have no meaning."""
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    out = np.full(rows * BINS, _EMPTY)
    open_row = np.diff(first) > 0
    for turn in range(2 * BINS):
        taking = open_row[row]
        if not taking.all():
            row, sets = row[taking], sets[taking]
        if not len(row):
            break
        value = mix(sets ^ _SEEDS[turn])
        at = (value & np.uint64(BINS - 1)).astype(np.int64) if turn < BINS else turn - BINS
        np.minimum.at(out, row * BINS + at, (np.uint64(turn) << np.uint64(55)) | (value >> np.uint64(9)))
        open_row &= (out.reshape(rows, BINS) == _EMPTY).any(axis=1)
    return out.reshape(rows, BINS)


def sketch_bytes(coordinates: np.ndarray) -> np.ndarray:
    """One byte for every coordinate; different coordinates share it once in 256 times."""
    return (mix(coordinates) >> np.uint64(56)).astype(np.uint8)


def band_width(similarity: float, miss: float = 1e-8) -> int:
    """The widest bands with which a pair of this similarity shares no band with probability ``miss`` at most."""
    return max(w for w in range(1, BINS + 1) if w == 1 or (1 - similarity**w) ** (BINS // w) <= miss)


def least_agreement(similarity: float, miss: float = 1e-9) -> int:
    """How many coordinates a pair of this similarity shares at least, but with probability ``miss``."""
    below = 0.0
    for n in range(BINS + 1):
        below += math.comb(BINS, n) * similarity**n * (1 - similarity) ** (BINS - n)
        if below > miss:
            return n
    return BINS


def set_digests(sets: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """16 bytes that name the set; None for an empty one."""
    raw = sets.tobytes()
    return [
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
        for a, b in zip(first[:-1].tolist(), first[1:].tolist())
    ]
