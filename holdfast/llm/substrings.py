"""Removal of repeated word sequences by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. Two equal windows that begin at
words p and q share, for some shift below ``PERIOD``, positions p + shift and q + shift
that are both in the cover modulo the period. An anchor is the hash of ``ANCHOR`` words at
a cover position, short enough to lie within the window for every such shift. So a window
that occurs twice holds an anchor that occurs twice, and only a quarter of all positions
have to be hashed and shuffled to find it. Around anchors that occur twice, the windows
that hold them are hashed in full, by two hashes of together 96 bits, and compared again; words that equal windows cover go. Back in its own
chunk a window is told from others of that chunk by the first hash.

Documents are dealt into chunks of at most 256 rows and ``CHUNK_ROW << CHUNK_BITS`` bytes; the more
bytes a row has, the fewer share its chunk, and a longer one is a chunk of its own. What is shuffled is one row for each
hash and chunk (two if it occurs there more than once), so a passage that a third of all
documents share is one row a chunk, and groups of equal hashes are only counted, never
listed in pairs. The texts meet their chunk's repeated hashes through one exchange, used
for both steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.llm.store import stored
from holdfast.llm.textarrays import Words, mix, row_slices, utf8, window_hashes, words

WINDOW = 35
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
ANCHOR = WINDOW - PERIOD + 1
CHUNK_BITS = 8  # most rows of a chunk, as a power of two
CHUNK_ROW = 1 << 15  # bytes up to which rows come as many to a chunk; twice as many bytes, half as many rows

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_ANCHORS = "hash bigint, chunk bigint"
_WINDOWS = "hash bigint, second int, chunk bigint"


class _Slice:
    """Words of some rows, with the windows that lie within one row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words: Words = words(data, offsets)
        self.rows = len(offsets) - 1
        row = self.words.row
        self.first = np.searchsorted(row, np.arange(self.rows + 1))
        count = max(0, len(row) - WINDOW + 1)
        self.whole = row[:count] == row[len(row) - count :]  # windows that lie within one row

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors of rows that are long enough for a window."""
        row = self.words.row
        hashes = window_hashes(self.words.hashes, ANCHOR)
        inside = row[: len(hashes)] == row[len(row) - len(hashes) :]
        place = (np.arange(len(hashes)) - self.first[row[: len(hashes)]]) % PERIOD
        long = np.diff(self.first)[row[: len(hashes)]] >= WINDOW
        at = np.flatnonzero(inside & long & _IN_COVER[place])
        return at, hashes[at]

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor with one of the hashes (sorted)."""
        at, hashes = self.anchors()
        at = at[_member(hashes, repeated)]
        near = np.zeros(len(self.whole) + 1, np.int64)
        np.add.at(near, np.minimum(np.maximum(at - PERIOD + 1, 0), len(self.whole)), 1)
        np.add.at(near, np.minimum(at + 1, len(self.whole)), -1)
        return np.flatnonzero((np.cumsum(near)[:-1] > 0) & self.whole)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Whether each word is in a window that begins at one of the starts."""
        edge = np.zeros(len(self.words.row) + 1, np.int64)
        edge[starts] += 1
        edge[starts + WINDOW] -= 1
        return np.cumsum(edge)[:-1] > 0


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


def _rows_of(chunk: int, **hashes: np.ndarray) -> pa.RecordBatch:
    """One row a hash (or pair of hashes), two if it occurs more than once."""
    order = np.lexsort([*hashes.values()])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for values in hashes.values():
        new[1:] |= values[order[1:]] != values[order[:-1]]
    first = np.flatnonzero(new)
    again = first[np.diff(first, append=len(order)) > 1]
    rows = order[np.concatenate((first, again))]
    columns = {name: pa.array(values[rows].view(f"i{values.itemsize}")) for name, values in hashes.items()}
    return pa.record_batch(columns | {"chunk": pa.array(np.full(len(rows), chunk))})


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(texts)
    for low, high in row_slices(offsets):
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        for low, high, data, offsets in _slices(batch.column("text")):
            part = _Slice(data, offsets)
            at, hashes = part.anchors()
            chunk = chunks[low:high][part.words.row[at]]
            for c in np.unique(chunk):
                yield _rows_of(c, hash=hashes[chunk == c])


def _window_pairs(part: _Slice, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows that begin at ``starts``, the second of 32 bits."""
    first = window_hashes(part.words.hashes, WINDOW)[starts]
    second = window_hashes(mix(~part.words.hashes), WINDOW)[starts]
    return first, (second >> np.uint64(32)).astype(np.uint32)


def _window_rows(docs: pa.Table, repeated: pa.Table) -> pa.Table:
    found = [(np.empty(0, np.uint64), np.empty(0, np.uint32))]
    known = np.sort(repeated["hash"].to_numpy().view(np.uint64))
    if len(known) and docs.num_rows:
        for _, _, data, offsets in _slices(docs["text"].combine_chunks()):
            part = _Slice(data, offsets)
            starts = part.candidates(known)
            if len(starts):
                found.append(_window_pairs(part, starts))
    first, second = (np.concatenate(x) for x in zip(*found))
    chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
    return pa.Table.from_batches([_rows_of(chunk, hash=first, second=second)])


def _repeated(hashes: DataFrame, *by: str) -> DataFrame:
    """Hash and chunk of rows whose hashes occur at least twice; counted, so no group is gathered."""
    count = F.count(F.lit(1)).over(Window.partitionBy(*by))
    return hashes.withColumn("n", count).filter("n > 1").select("hash", "chunk")


def _chunk(number: Column, size: Column) -> Column:
    """The chunk of the row with this number and so many bytes of text."""
    halvings = sum((size >= CHUNK_ROW << k).cast("int") for k in range(CHUNK_BITS))
    place = F.call_function("shiftright", number, CHUNK_BITS - halvings)
    return place * 16 + halvings  # rows of other sizes have chunks of their own


def remove_repeats(
    docs: DataFrame, keep: Sequence[str] | None = None, leave: bool = False, is_scan: bool = False
) -> DataFrame:
    """Remove every word of ``text`` that a repeated window covers.

    Returns the columns ``keep`` (all by default) with ``text`` replaced by the words that
    stay, joined by one space (with ``leave``, a text that loses nothing is left as it is), and adds ``n_words`` and ``n_removed`` (columns of these names
    are replaced). A window is repeated if its words also begin at another position of
    the same or another row; all are judged on the input. A null or empty text has no
    words and becomes empty. Repeated rows are rows of their own, so long ones repeat
    each other.

    Rows are numbered by their place in the input, which is read twice. So ``docs`` is written
    first, unless ``is_scan`` says that it is a table scan, which has the same order each time.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("text", "n_words", "n_removed")]
    chunk = "chunk"
    renamed = {c: f"c{i}" for i, c in enumerate(keep)}
    asked = docs.select(*(F.col(c).alias(renamed[c]) for c in keep), "text")
    if not is_scan:
        asked = stored(asked, "repeats-input")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    dealt = asked.withColumn(chunk, _chunk(F.monotonically_increasing_id(), size))
    schema = StructType(
        [
            *dealt.drop("text", chunk).schema.fields,
            *StructType.fromDDL("text string, n_words bigint, n_removed bigint").fields,
        ]
    )

    def kept_rows(rows: pa.Table, repeated: pa.Table) -> pa.Table:
        known = np.sort(repeated["hash"].to_numpy().view(np.uint64))
        texts, n_words, n_removed = [], [], []
        column = rows["text"].combine_chunks()
        for low, high, data, offsets in _slices(column):
            part = _Slice(data, offsets)
            hashes = window_hashes(part.words.hashes, WINDOW)
            starts = np.flatnonzero(part.whole)
            gone = part.covered(starts[_member(hashes[starts], known)])
            n_words.append(np.diff(part.first))
            removed = np.concatenate(([0], np.cumsum(gone)))
            n_removed.append(np.diff(removed[part.first]))
            raw = data.tobytes()
            for i in range(high - low):
                text = raw[offsets[i] : offsets[i + 1]]
                if n_removed[-1][i]:
                    stays = ~gone[part.first[i] : part.first[i + 1]]
                    text = b" ".join(w for w, s in zip(text.split(), stays.tolist()) if s)
                elif not leave:
                    text = b" ".join(text.split())
                texts.append(text.decode())
        new = [pa.array(texts, pa.string()), *(pa.array(np.concatenate(x), pa.int64()) for x in (n_words, n_removed))]
        columns = [rows[f.name] for f in schema.fields[:-3]]
        return pa.table([*columns, *new], names=schema.names)

    anchors = _repeated(dealt.select("text", chunk).mapInArrow(_anchor_rows, _ANCHORS), "hash")
    grouped = dealt.groupBy(chunk)
    windows = grouped.cogroup(anchors.groupBy(chunk)).applyInArrow(_window_rows, _WINDOWS)
    result = grouped.cogroup(_repeated(windows, "hash", "second").groupBy(chunk)).applyInArrow(kept_rows, schema)
    return result.select(*(F.col(renamed[c]).alias(c) for c in keep), "text", "n_words", "n_removed")
