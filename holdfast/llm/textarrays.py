"""Whole texts of an Arrow column as numpy arrays: bytes, words, windows, code points.

Nothing here loops over texts or words in Python. Rows are taken in slices of a few
megabytes; one text of any length is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple
import unicodedata

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_STEP = 4096


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64)."""
    h = h ^ (h >> _U64(30))
    h *= _U64(0xBF58476D1CE4E5B9)
    h ^= h >> _U64(27)
    h *= _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row comes alone."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = max(high, low + 1)
        yield low, high
        low = high


class Words(NamedTuple):
    hashes: np.ndarray
    row: np.ndarray  # row of each word
    start: np.ndarray  # byte positions in the slice
    end: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all rows with 64-bit hashes, in order."""
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    first[starts] |= solid[starts]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] |= solid[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(start), _U64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + SLICE_BYTES, "right")))
        hashes[low:high] = _hash_words(data, solid, start[low:high], end[high - 1])
        low = high
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(hashes, row, start, end)


def _hash_words(data: np.ndarray, solid: np.ndarray, start: np.ndarray, stop: int) -> np.ndarray:
    base, size = start[0], stop - start[0]
    at = start - base
    spans = np.diff(at, append=size)
    place = np.arange(size) - np.repeat(at, spans)
    value = np.where(solid[base:stop], data[base:stop].astype(_U64) + _U64(1), _U64(0))
    value *= _multipliers(0, _STEP)[place % _STEP]
    if spans.max() > _STEP:
        value *= _multipliers(1, int(spans.max()) // _STEP + 1)[place // _STEP]
    return mix(np.add.reduceat(value, at))


@cache
def _multipliers(kind: int, count: int) -> np.ndarray:
    """Odd numbers without order. Powers of one base would be multiples of ever higher
    powers of two in sums of alternating signs, so that long words of a certain form collide."""
    table = mix((np.arange(count, dtype=_U64) * _U64(2) + _U64(kind)) * _U64(_BASE)) | _U64(1)
    table[0] = 1  # so a word's hash does not depend on whether longer ones are near
    return table


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbours, whatever rows they belong to."""
    if len(hashes) < n:
        return np.empty(0, _U64)
    block, width, total, size, rest = hashes, 1, None, 0, n
    while True:
        if rest & 1:
            if total is None:
                total = block
            else:
                count = len(hashes) - size - width + 1
                total = total[:count] + _U64(pow(_WORD_BASE, size, 1 << 64)) * block[size : size + count]
            size += width
        rest >>= 1
        if not rest:
            return mix(total ^ _U64(n))
        block = block[:-width] + _U64(pow(_WORD_BASE, width, 1 << 64)) * block[width:]
        width *= 2


@cache
def _letters() -> np.ndarray:
    return np.fromiter(
        (unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000
    )


def is_letter(points: np.ndarray) -> np.ndarray:
    return _letters()[points]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between two spaces, and their offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 2 for t in texts], out=offsets[1:])
    joined = "".join(f" {t} " for t in texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def gram_buckets(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash bucket of the n-gram that starts at each code point."""
    count = max(0, len(points) - n + 1)
    h = np.full(count, n, np.uint32)
    for k in range(n):
        h *= np.uint32(0x9E3779B1)
        h ^= points[k : k + count]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)
