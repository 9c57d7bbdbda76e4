"""Numpy helpers for Arrow batches of texts.

Texts of a batch are handled as one byte array with offsets, in blocks of about
``BLOCK_BYTES``, so that the work per byte is vectorised and memory stays bounded by a
block or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(ends):
        ends = np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def blocks(
    data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of runs of texts of about ``size`` bytes."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), rows)
        part = offsets[first : end + 1]
        yield first, end, data[part[0] : part[-1]], part - part[0]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + mix(np.array([seed]))) | np.uint64(1)


_BYTES = random_words(256, 7)


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; none crosses from one text into the next."""
    if not len(member):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.zeros(len(member) + 1, bool)
    inner = offsets[1:-1]
    edge[inner] = True
    before = np.empty(len(member), bool)
    before[0] = False
    before[1:] = member[:-1]
    starts = np.flatnonzero(member & (~before | edge[:-1]))
    after = np.empty(len(member), bool)
    after[-1] = False
    after[:-1] = member[1:]
    ends = np.flatnonzero(member & (~after | edge[1:])) + 1
    return starts, ends


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes ``data[start:end]``; runs must not overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(first, lengths)
    longest = int(lengths.max())
    with np.errstate(over="ignore"):
        powers = np.ones(longest, np.uint64)
        if longest > 1:
            powers[1:] = np.cumprod(np.full(longest - 1, _BASE, np.uint64))
        values = _BYTES[data[place + np.repeat(starts, lengths)]] * powers[place]
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _GOLDEN)


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes: one fewer per extra word."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for k, factor in enumerate(random_words(size, seed)):
            total += words[k : k + count] * factor
        return mix(total)


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For sorted byte positions: bounds of each text's entries, one more than texts."""
    return np.searchsorted(starts, offsets, "left")
