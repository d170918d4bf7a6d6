"""Vectorised helpers over the text column of Arrow batches.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return.  All helpers take a null text as a text without words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute

# Odd multipliers of rolling hashes modulo 2**64, and those of a well-known bit mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

#: Bytes of text that are worked on at a time; one longer text is worked on alone.
SLICE_BYTES = 1 << 20

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept per worker up to some millions."""
    if len(_POWERS.get(base, ())) < n:
        size = max(n, 1 << 20)
        series = np.full(size, base, np.uint64)
        series[0] = 1
        np.multiply.accumulate(series, out=series)
        if size > 1 << 23:
            return series[:n]
        _POWERS[base] = series
    return _POWERS[base][:n]


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for arrays of bounds; equal spans give equal hashes."""
    n = len(values) + 1
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(n, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, n)[1:], out=sums[1:])
    found = (sums[end] - sums[start]) * powers(inverse, n)[start]
    return mix(found + (end - start).astype(np.uint64) * np.uint64(BYTE_BASE))


def windows(hashes: np.ndarray, size: int, base: int = WORD_BASES[0]) -> np.ndarray:
    """Hash of each run of ``size`` items, by its first item; also of runs over document bounds."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    start = np.arange(len(hashes) - size + 1)
    return span_hash(hashes, start, start + size, base)


class Words(NamedTuple):
    """Words of some texts: byte bounds, hashes, and the first word of each text (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def raw_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with one more offset at the end; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words(texts: pa.Array) -> Words:
    raw, offsets = raw_of(texts)
    solid = _SOLID[raw]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[heads], ends[tails] = solid[heads], solid[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(start, end, span_hash(raw, start, end), np.searchsorted(start, offsets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a slice have few bytes; every row is in one slice."""
    for batch in batches:
        # From the lengths: the texts of the whole batch are not copied.
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def joined(values: list[bytes] | list[np.ndarray], kind: type = np.uint64) -> np.ndarray:
    return np.concatenate(values) if values else np.zeros(0, kind)


def sequence_keys(found: Words) -> list[bytes]:
    """16 bytes for the word sequence of each text: equal for texts with the same words in order."""
    a, b = (span_hash(found.hash, found.first[:-1], found.first[1:], base) for base in WORD_BASES)
    both = np.stack([a, b], 1).astype("<u8").tobytes()
    return [both[i:i + 16] for i in range(0, len(both), 16)]
