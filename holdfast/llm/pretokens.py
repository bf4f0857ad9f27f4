"""Pre-tokens of byte-level BPE, found in numpy, and a bounded table of what they encode to.

The tokenizer first cuts a text into pre-tokens (contractions, letters, digits, other
signs, each with the space before it, and white space) and then merges inside each of
them, looking at nothing else. Two facts follow. A vocabulary string that encodes alone as
one token does so wherever it is a pre-token: such strings are proved once, by encoding
the whole vocabulary (``whole_tokens``), and never merged again. And any other pre-token
has to be merged once, as long as it is remembered.

Cuts depend on neighbouring characters only, so they are found for megabytes at a time
from the class of each character; classes beyond ASCII are asked of the library itself.
Pre-tokens of up to 15 bytes are kept under their own bytes (with the length, two 64-bit
numbers), so a lookup is exact. The table has a fixed number of slots and starts anew when
it is full; longer pre-tokens are merged by the library each time a slice holds them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from holdfast.llm.textarrays import mix, row_slices, utf8

SLICE_BYTES = 1 << 20
SLOT_BITS, FULL = 20, 0.6  # slots of a worker's table, and the share of them that may be taken
KEY_BYTES = 15
PART = 1 << 18  # pieces looked up at a time; an empty table has room for them

_U64 = np.uint64
SPACE, LETTER, NUMBER, OTHER, _UNKNOWN = 0, 1, 2, 3, 255
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], _U64)
# After these, pre-tokens always part, whatever stands around them.
_SAFE_CUT = re.compile(rb"[A-Za-z](?= [A-Za-z]|[!-@\[-`{-~])|[0-9](?=[!-/:-~])")


def _byte_characters() -> str:
    """The character that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


_CHARACTERS = _byte_characters()
_POINTS = np.array([ord(c) for c in _CHARACTERS], np.uint32)
_BYTE_OF = {c: b for b, c in enumerate(_CHARACTERS)}


class WholeTokens(NamedTuple):
    """Vocabulary strings of up to 15 bytes that encode alone as one token."""

    low: np.ndarray
    high: np.ndarray
    ids: np.ndarray


def load_tokenizer(path: str):
    """The tokenizer, and the ids of its special strings; refused if it is of another kind."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    about = json.loads(tokenizer.to_str())
    cut, model, added = about["pre_tokenizer"] or {}, about["model"], about["added_tokens"]
    plain = (
        about["normalizer"] is None
        and about["truncation"] is None
        and about["padding"] is None
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
        and (model["type"], model["dropout"]) == ("BPE", None)
        and not any(model[k] for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError(f"{path} is no plain byte-level BPE")
    return tokenizer, {a["content"].encode(): a["id"] for a in added}


def _keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the length of pieces of at most ``KEY_BYTES`` bytes as two numbers."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    low = words[start] & _MASKS[np.minimum(size, 8)]
    high = words[start + 8] & _MASKS[np.clip(size - 8, 0, 7)]
    return low, high | (size.astype(_U64) << _U64(56))


@cache
def whole_tokens(path: str) -> WholeTokens:
    """Encode every vocabulary string alone and keep those that come back as their own id."""
    tokenizer, _ = load_tokenizer(path)
    texts, ids = [], []
    for name, i in tokenizer.get_vocab(with_added_tokens=False).items():
        raw = bytes(_BYTE_OF[c] for c in name)
        if len(raw) <= KEY_BYTES:
            try:
                texts.append(raw.decode())
            except UnicodeDecodeError:  # no text holds it as a pre-token
                continue
            ids.append(i)
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    proved = [(t.encode(), i) for t, i, e in zip(texts, ids, found) if e.ids == [i]]
    size = np.array([len(raw) for raw, _ in proved], np.int64)
    data = np.frombuffer(b"".join(raw for raw, _ in proved), np.uint8)
    return WholeTokens(*_keys(data, np.cumsum(size) - size, size), np.array([i for _, i in proved], np.uint32))


class _Table:
    """Numbers for keys, by open addressing; as many slots for any input."""

    def __init__(self) -> None:
        self.low, self.high = np.zeros(1 << SLOT_BITS, _U64), np.zeros(1 << SLOT_BITS, _U64)
        self.number = np.full(1 << SLOT_BITS, -1, np.int32)
        self.count = 0

    def place(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key, and where each new key (in order of number) was met."""
        slot = (mix(low ^ mix(high)) >> _U64(64 - SLOT_BITS)).astype(np.int64)
        number, fresh = np.full(len(low), -1, np.int32), [np.empty(0, np.int64)]
        open_ = np.arange(len(low))
        while len(open_):
            at = slot[open_]
            held = self.number[at]
            free = held < 0
            same = ~free & (self.low[at] == low[open_]) & (self.high[at] == high[open_])
            number[open_[same]] = held[same]
            claims, at_free = open_[free], at[free]
            if len(claims):
                turn = np.arange(len(claims), dtype=np.int32)
                self.number[at_free] = turn  # of those that claim a slot the last one gets it
                won = self.number[at_free] == turn
                claims, at_free = claims[won], at_free[won]
                new = np.arange(self.count, self.count + len(claims), dtype=np.int32)
                self.low[at_free], self.high[at_free], self.number[at_free] = low[claims], high[claims], new
                number[claims] = new
                self.count += len(claims)
                fresh.append(claims)
            slot[open_[~free & ~same]] += 1
            slot &= (1 << SLOT_BITS) - 1
            open_ = open_[number[open_] < 0]
        return number, np.concatenate(fresh)


class Pieces:
    """Token ids and counts of whole texts by their pre-tokens."""

    def __init__(self, path: str, whole: WholeTokens):
        self.tokenizer, self.special = load_tokenizer(path)
        self.model, self.whole = self.tokenizer.model, whole
        names = sorted(self.special, key=len, reverse=True)
        self._special = re.compile(b"|".join(map(re.escape, names))) if names else None
        self._class = np.full(0x110000, _UNKNOWN, np.uint8)
        self._learn_classes(np.arange(128))
        self._forget()

    def _forget(self) -> None:
        self.table = _Table()
        number, _ = self.table.place(self.whole.low, self.whole.high)
        taken = int(FULL * (1 << SLOT_BITS))
        self.size, self.begin = np.zeros(taken, np.int32), np.zeros(taken, np.int64)
        count = len(self.whole.ids)
        self.size[:count], self.begin[:count] = 1, np.arange(count)
        self.known = np.empty(count, np.uint32)
        self.known[number] = self.whole.ids

    def _learn_classes(self, points: np.ndarray) -> None:
        """Ask the library which signs each character is cut together with."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for point in points.tolist():
            kinds = (k for k, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(cut(mate + chr(point))) == 1)
            self._class[point] = next(kinds, SPACE)

    def classes(self, data: np.ndarray) -> np.ndarray:
        """The class of the character that each byte belongs to."""
        found = self._class[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            padded = np.concatenate((data, np.zeros(3, np.uint8)))
            first, (b, c, d) = data[lead].astype(np.uint32), (padded[lead + k].astype(np.uint32) & 63 for k in (1, 2, 3))
            two = (first & 31) << 6 | b
            three = (first & 15) << 12 | b << 6 | c
            four = (first & 7) << 18 | b << 12 | c << 6 | d
            point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
            kind = self._class[point]
            if (kind == _UNKNOWN).any():
                self._learn_classes(np.unique(point[kind == _UNKNOWN]))
                kind = self._class[point]
            found[lead] = kind
            for k, above in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
                some = first >= above
                found[lead[some] + k] = kind[some]
        return found

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pre-tokens of all rows begin."""
        n = len(data)
        kinds = self.classes(data)
        row = np.zeros(n + 4, bool)
        row[offsets] = True
        first = row[:n].copy()
        first[1:] |= kinds[1:] != kinds[:-1]
        begin = np.flatnonzero(first)
        end, kind = np.append(begin[1:], n), kinds[begin]
        token = np.zeros(n + 4, bool)
        solid = kind != SPACE
        glued = solid & ~row[begin] & (data[begin - 1] == 0x20)  # begins with the space before it
        token[begin[~glued]] = True
        last = end[~solid & ~row[end]] - 1  # the last white space before a sign parts from the rest
        for _ in range(3):
            last -= (data[last] & 0xC0) == 0x80
        token[last] = True
        quote = np.flatnonzero((kind == OTHER) & ~glued & (end - begin == 1) & ~row[end])
        quote = quote[data[begin[quote]] == 0x27]
        if len(quote):
            quote = quote[kind[quote + 1] == LETTER]
            at = begin[quote]
            padded = np.concatenate((data, np.zeros(4, np.uint8)))
            one, two = padded[at + 1], padded[at + 2]
            short = np.isin(one, list(b"stmd"))
            pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            long = ~short & pair & ~row[at + 2]
            token[at[short | long] + 1] = False
            token[at[short] + 2] = True
            token[at[long] + 3] = True
        return np.flatnonzero(token[:n])

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets with more bounds: around special strings, and inside long rows; ids of special ones, else -1."""
        raw, bounds, ids = data.tobytes(), [], {}
        if self._special:
            at = 0
            while found := self._special.search(raw, at):
                low, high = found.span()
                inside = np.searchsorted(offsets, low, "right") == np.searchsorted(offsets, high - 1, "right")
                if inside:
                    bounds += [low, high]
                    ids[low] = self.special[found.group()]
                at = high if inside else low + 1
        for i in np.flatnonzero(np.diff(offsets) > SLICE_BYTES):
            at = int(offsets[i])
            while (found := _SAFE_CUT.search(raw, at + SLICE_BYTES, int(offsets[i + 1]))) is not None:
                at = found.start() + 1
                bounds.append(at)
        if not bounds:
            return offsets, np.full(len(offsets) - 1, -1)
        # A cut inside a special string is none; empty rows keep their place.
        special = np.array(sorted(ids), np.int64)
        bounds = np.unique(np.array(bounds, np.int64))
        if len(special):
            before = np.maximum(np.searchsorted(special, bounds, "left") - 1, 0)
            reach = np.array([len(self._special.match(raw, int(s)).group()) for s in special], np.int64)
            inner = (special[before] < bounds) & (bounds < special[before] + reach[before])
            bounds = bounds[~inner]
        bounds = bounds[~np.isin(bounds, offsets)]
        merged = np.sort(np.concatenate((offsets, bounds)), kind="stable")
        mark = np.full(len(merged) - 1, -1)
        # Of equal bounds (empty rows) the last one begins what follows.
        for low, i in ids.items():
            mark[np.searchsorted(merged, low, "right") - 1] = i
        return merged, mark

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The number of each piece; beyond the table's they count the extra ids lists (negative, from -1)."""
        size = end - start
        short = np.flatnonzero(size <= KEY_BYTES)
        if self.table.count + len(short) > len(self.size):
            self._forget()
        number = np.empty(len(start), np.int64)
        low, high = _keys(data, start[short], size[short])
        number[short], fresh = self.table.place(low, high)
        text = ""
        if len(fresh) or len(short) < len(start):
            text = _POINTS[data].tobytes().decode("utf-32-le")  # one character a byte
        if len(fresh):
            new = short[fresh]
            ids = [self._merge(text[a:b]) for a, b in zip(start[new].tolist(), end[new].tolist())]
            counts = np.array([len(x) for x in ids], np.int32)
            first = self.table.count - len(new)
            self.size[first : self.table.count] = counts
            self.begin[first : self.table.count] = len(self.known) + np.cumsum(counts) - counts
            self.known = np.concatenate((self.known, np.array([i for x in ids for i in x], np.uint32)))
        extra: dict[str, int] = {}
        for k in np.flatnonzero(size > KEY_BYTES).tolist():
            number[k] = -1 - extra.setdefault(text[start[k] : end[k]], len(extra))
        return number, [self._merge(x) for x in extra]

    def _merge(self, piece: str) -> list[int]:
        return [token.id for token in self.model.tokenize(piece)]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text; null is empty."""
        total = np.zeros(len(texts), np.int64)
        for row, count, _, _ in self._parts(texts):
            np.add.at(total, row, count)
        return total

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's; null is empty."""
        total, found = np.zeros(len(texts), np.int64), [np.empty(0, np.uint32)]
        for row, count, begin, size in self._parts(texts):
            np.add.at(total, row, count)
            after = np.cumsum(size)
            found.append(self._pool[np.repeat(begin - (after - size), size) + np.arange(after[-1])])
        return np.concatenate(found), total

    def _parts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """Some pieces at a time: rows and their tokens, and where in ``_pool`` each piece's ids are and how many."""
        data, offsets = utf8(texts)
        for low, high in row_slices(offsets, SLICE_BYTES):
            part = data[offsets[low] : offsets[high]]
            rows = offsets[low : high + 1] - offsets[low]
            bounds, mark = self._segments(part, rows)
            for a, b in row_slices(bounds, SLICE_BYTES):
                row = low + np.searchsorted(rows, bounds[a:b], "right") - 1
                for count, begin, size in self._sized(part[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], mark[a:b]):
                    some = count > 0
                    yield row[some], count[some], begin, size

    def _sized(self, data: np.ndarray, bounds: np.ndarray, mark: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Tokens of each segment among some pieces, and where each piece's ids begin and how many they are."""
        starts = self.starts(data, bounds)
        of = np.searchsorted(bounds, starts, "right") - 1
        if (mark >= 0).any():  # a special string is one piece with an id of its own
            stays = (mark[of] < 0) | (starts == bounds[of])
            starts, of = starts[stays], of[stays]
        ends = np.append(starts[1:], len(data))
        for low in range(0, len(starts), PART):
            start, end, own = starts[low : low + PART], ends[low : low + PART], mark[of[low : low + PART]]
            number, extra = self._numbers(data, start, end)
            special = np.flatnonzero(own >= 0)
            more = np.array([i for x in extra for i in x], np.uint32)
            self._pool = np.concatenate((self.known, more, own[special].astype(np.uint32)))
            size, begin = self.size[number].astype(np.int64), self.begin[number]
            other = np.flatnonzero(number < 0)
            if len(other):
                sizes = np.array([len(x) for x in extra], np.int64)
                size[other] = sizes[-1 - number[other]]
                begin[other] = (len(self.known) + np.cumsum(sizes) - sizes)[-1 - number[other]]
            size[special], begin[special] = 1, len(self.known) + len(more) + np.arange(len(special))
            running = np.concatenate(([0], np.cumsum(size)))
            yield np.diff(running[np.searchsorted(start, bounds)]), begin, size


_pieces: dict[str, Pieces] = {}


def pieces(path: str, whole: WholeTokens) -> Pieces:
    """The pre-token table of this worker process."""
    if path not in _pieces:
        _pieces[path] = Pieces(path, whole)
    return _pieces[path]
