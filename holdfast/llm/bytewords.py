"""Words as runs of bytes of a class, and crc32 of runs of words, in numpy.

Bytes from 0x80 on belong to every class, so characters beyond ASCII are never cut. A text
longer than ``SLICE_BYTES`` is taken in parts that end between words.

The register of crc32 is linear: running it over the bytes of two strings is running it over
the first, then over as many zero bytes as the second has, and adding (xor) what the second
gives alone. So each word is run once, and the crc32 of a run of words needs a few table
lookups more for each word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from holdfast.llm.textarrays import row_slices, utf8

SLICE_BYTES = 1 << 20

_U32 = np.uint32
_POLYNOMIAL = 0xEDB88320  # of crc32, bits reversed
_ONES = _U32(0xFFFFFFFF)
_SHORT = 64  # bytes of words that are run by table
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(ascii_members: str) -> np.ndarray:
    """Which bytes belong: the given characters and all of 0x80 to 0xFF."""
    return np.isin(np.arange(256), list(ascii_members.encode())) | (np.arange(256) >= 0x80)


class Words(NamedTuple):
    """Some rows' words; the first ``context`` words of the first row were in the part before."""

    row: int  # number of the first row
    data: np.ndarray  # A-Z lower-cased
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # index of the first word of each row, and the number of words
    context: int


def words(texts: pa.Array, member: np.ndarray, context: int = 0) -> Iterator[Words]:
    """The words of all rows by slices; parts of a long row repeat the last ``context`` words before them."""
    data, offsets = utf8(texts)
    for low, high in row_slices(offsets, SLICE_BYTES):
        part = _LOWER[data[offsets[low] : offsets[high]]]
        if len(part) <= SLICE_BYTES:
            yield _words(low, part, offsets[low : high + 1] - offsets[low], member, 0)
            continue
        at, begin, before = 0, 0, 0
        while at < len(part):
            end = at + SLICE_BYTES
            while end < len(part):  # up to a byte that is in no word
                gap = np.flatnonzero(~member[part[end : end + SLICE_BYTES]])
                if len(gap):
                    end += int(gap[0])
                    break
                end += SLICE_BYTES
            end = min(end, len(part))
            found = _words(low, part[begin:end], np.array([0, end - begin]), member, before)
            yield found
            before = min(context, len(found.start))
            at, begin = end, begin + int(found.start[-before]) if before else end


def _words(row: int, data: np.ndarray, offsets: np.ndarray, member: np.ndarray, context: int) -> Words:
    solid = member[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] |= solid[begins]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] |= solid[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(row, data, start, end, np.searchsorted(start, offsets), context)


@cache
def _steps() -> np.ndarray:
    """What one byte makes of the register."""
    table = np.arange(256, dtype=_U32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ _U32(_POLYNOMIAL), table >> 1)
    return table


@cache
def _alone() -> np.ndarray:
    """The register after a byte and 0, 1, 2, ... zero bytes, from zero."""
    rows = [_steps()]
    for _ in range(_SHORT - 1):
        rows.append(_step(rows[-1]))
    return np.stack(rows)


@cache
def _zeros(times: int) -> np.ndarray:
    """For each byte of the register, what 0 to ``_SHORT`` times ``times`` zero bytes make of it."""
    start = (np.arange(256, dtype=_U32)[None, :] << (_U32(8) * np.arange(4, dtype=_U32))[:, None]).astype(_U32)
    rows = [start]
    for _ in range(_SHORT):
        value = rows[-1]
        if times == 1:
            value = _step(value)
        else:
            value = _shift(value.ravel(), np.full(value.size, _SHORT), times // _SHORT).reshape(value.shape)
        rows.append(value)
    return np.stack(rows)


def _step(state: np.ndarray, byte: int = 0) -> np.ndarray:
    return _steps()[(state ^ _U32(byte)) & _U32(255)] ^ (state >> _U32(8))


def _shift(state: np.ndarray, count: np.ndarray, times: int = 1) -> np.ndarray:
    """The register after ``count`` (up to ``_SHORT``) times ``times`` zero bytes."""
    table = _zeros(times)
    total = table[count, 0, state & _U32(255)]
    for k in range(1, 4):
        total ^= table[count, k, (state >> _U32(8 * k)) & _U32(255)]
    return total


def after_zeros(state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The register after any number of zero bytes, digit by digit of the number."""
    done = _shift(state, count % _SHORT)
    rest, times = count // _SHORT, _SHORT
    while rest.any():
        done = _shift(done, rest % _SHORT, times)
        rest, times = rest // _SHORT, times * _SHORT
    return done


def registers(found: Words) -> np.ndarray:
    """The register after each word alone, from zero."""
    size = found.end - found.start
    if not len(size):
        return np.empty(0, _U32)
    inside = np.zeros(len(found.data) + 1, np.int8)
    inside[found.start] += 1
    inside[found.end] -= 1
    flat = found.data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    after = np.cumsum(size)
    to_end = np.repeat(after, size) - np.arange(1, len(flat) + 1)
    value = _alone()[np.minimum(to_end, _SHORT - 1), flat]
    state = np.bitwise_xor.reduceat(value, after - size)
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        whole = [zlib.crc32(found.data[a:b].tobytes()) for a, b in zip(found.start[long], found.end[long])]
        state[long] = np.array(whole, _U32) ^ _ONES ^ after_zeros(np.full(len(long), _ONES), size[long])
    return state


def run_crcs(found: Words, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words joined by a space: the places of their last words, and their crc32.

    Runs that end in a word of the part before are left out.
    """
    alone, size = registers(found), found.end - found.start
    place = np.arange(len(size)) - np.repeat(found.bounds[:-1], np.diff(found.bounds))
    state = np.full(len(size), _ONES)
    for n in range(1, longest + 1):
        if n > 1:  # go on from the run that ends one word earlier
            state = _step(np.concatenate((_ONES[None], state[:-1]))[: len(size)], 0x20)
        state = after_zeros(state, size) ^ alone
        last = np.flatnonzero(place >= n - 1)
        last = last[last >= found.context]
        yield last, state[last] ^ _ONES
