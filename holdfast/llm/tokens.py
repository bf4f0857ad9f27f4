"""Token ids of whole texts, and files of them in Simple-8b coding.

A file starts with ``MAGIC`` and five 64-bit numbers (ids per block, documents, ids, blocks,
words), then: document ids (64-bit), a byte for each that says whether it is null, ids
per document, the word at which each block begins, and the words. All numbers are
little-endian. A word's top 4 bits select how many ids of how many bits the other 60
hold; an id that does not fit 60 bits is an escape, all ones, and follows as a word of its
own. Blocks are coded on their own, so any can be read by its offset.

Files follow each other in ascending order of document id: rows are range-partitioned by
id (and a hash of the text, so repeated ids can be split), sorted within partitions, and
each partition writes files of about ``FILE_IDS`` ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.columns import add_from_text
from holdfast.llm.pretokens import pieces, whole_tokens
from holdfast.llm.store import open_folder, stored, work_folder
from holdfast.llm.textarrays import row_slices, utf8

MAGIC = b"HFTOKS8B"
BLOCK_IDS, FILE_IDS = 1_024, 4_000_000
END_ID = 2
TASKS = 2_000

# Selectors of Simple-8b: ids a word, bits an id (fixed values of the published code).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

_ESCAPE = (1 << 60) - 1
_U64 = np.uint64


# The least ids that need 1, 2, ... bits, and 61 for those that need an escape.
_LIMITS = np.array([1 << b for b in range(60)] + [_ESCAPE], _U64)
_NEAR = np.sort(COUNTS)


def _first_fit(most: np.ndarray, first: int) -> np.ndarray:
    """The selector of most ids whose width suffices; 16 if the first id needs an escape."""
    fits = most[:, COUNTS[first:] - 1] <= WIDTHS[first:]
    return np.where(fits.any(axis=1), first + fits.argmax(axis=1), 16)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and the word offset of each block, one more than blocks."""
    ids = np.ascontiguousarray(ids, _U64)
    blocks = -(-len(ids) // BLOCK_IDS)
    begin = np.arange(blocks, dtype=np.int64) * BLOCK_IDS
    end = np.minimum(begin + BLOCK_IDS, len(ids))
    # Bits of each id, block by block; what follows the end of a block needs none.
    bits = np.zeros((blocks, BLOCK_IDS + _NEAR[-1] + 1), np.uint8)
    flat = np.zeros(blocks * BLOCK_IDS, np.uint8)
    flat[: len(ids)] = np.frexp(ids.astype(np.float64))[1]
    huge = np.flatnonzero(ids >= _U64(1 << 53))  # not exact as doubles
    flat[huge] = np.searchsorted(_LIMITS, ids[huge], "right")
    bits[:, :BLOCK_IDS] = flat.reshape(blocks, BLOCK_IDS)
    stride, bits = bits.shape[1] if blocks else 0, bits.reshape(-1)
    steps: list[tuple[np.ndarray, ...]] = []
    live, at, number = np.arange(blocks), np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    size = end - begin
    while len(live):
        here = at[live]
        window = live * stride + here
        most = np.maximum.accumulate(bits[window[:, None] + np.arange(15)], axis=1)
        selector = _first_fit(most, 5)
        low = np.flatnonzero(most[:, -1] <= 3)
        if len(low):
            wide = np.maximum.accumulate(bits[window[low, None] + np.arange(_NEAR[-1])], axis=1)
            selector[low] = _first_fit(wide, 0)
        escaped = selector == 16
        selector[escaped] = 15
        taken = np.minimum(COUNTS[selector], size[live] - here)
        steps.append((live, number[live], here + begin[live], selector, taken, escaped))
        number[live] += 1 + escaped
        at[live] += taken
        live = live[at[live] < size[live]]
    offsets = np.concatenate(([0], np.cumsum(number)))
    words = np.zeros(offsets[-1], _U64)
    if not steps:
        return words, offsets
    block, place, here, selector, taken, escaped = (np.concatenate(x) for x in zip(*steps))
    place = offsets[block] + place
    words[place] = selector.astype(_U64) << _U64(60)
    for s in range(2, 16):
        of = np.flatnonzero((selector == s) & ~escaped)
        for k in range(int(COUNTS[s])):
            some = of[taken[of] > k]
            words[place[some]] |= ids[here[some] + k] << _U64(int(WIDTHS[s]) * k)
    words[place[escaped]] |= _U64(_ESCAPE)
    words[place[escaped] + 1] = ids[here[escaped]]
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """The ids of the blocks that begin at ``offsets``; ``count`` ids in all."""
    selector = (words >> _U64(60)).astype(np.int64)
    payload = words & _U64(_ESCAPE)
    escape = (selector == 15) & (payload == _U64(_ESCAPE))
    # The word after an escape is an id, whatever it looks like: escapes come in runs of
    # alternating escape and id when read from left to right.
    if escape.any():
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(escape):
            if not raw[i]:
                raw[i + 1] = True
        escape &= ~raw
    else:
        raw = escape
    held = np.where(raw, 0, COUNTS[selector])
    # The last word of a block may have room for more ids than the block has.
    blocks = len(offsets) - 1
    sizes = np.full(blocks, BLOCK_IDS)
    if blocks:
        sizes[-1] = count - BLOCK_IDS * (blocks - 1)
    before = np.concatenate(([0], np.cumsum(held)))
    surplus = before[offsets[1:]] - before[offsets[:-1]] - sizes
    last = offsets[1:] - 1
    last = np.where(raw[last], last - 1, last) if len(words) else last
    held[last] -= surplus
    start = np.concatenate(([0], np.cumsum(held)))[:-1]
    ids = np.zeros(count, _U64)
    for s in range(2, 16):
        of = np.flatnonzero((selector == s) & ~raw & ~escape)
        mask = _U64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            some = of[held[of] > k]
            ids[start[some] + k] = (payload[some] >> _U64(int(WIDTHS[s]) * k)) & mask
    at = np.flatnonzero(escape)
    ids[start[at]] = words[at + 1]
    return ids


def write_file(stream, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
    words, offsets = pack(ids)
    sizes = [BLOCK_IDS, len(doc_ids), len(ids), len(offsets) - 1, len(words)]
    stream.write(MAGIC + np.array(sizes, "<i8").tobytes())
    stream.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    stream.write(np.array([d is None for d in doc_ids], "u1").tobytes())
    stream.write(np.asarray(lengths, "<i8").tobytes())
    stream.write(offsets.astype("<i8").tobytes())
    stream.write(words.astype("<u8").tobytes())


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, all ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    at = 8

    def take(count: int, kind: str) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    block, docs, count, blocks, size = (int(x) for x in take(5, "<i8"))
    if block != BLOCK_IDS:
        raise ValueError(f"blocks of {block} ids are not supported")
    doc_ids, null = take(docs, "<i8").tolist(), take(docs, "u1")
    lengths, offsets, words = take(docs, "<i8"), take(blocks + 1, "<i8"), take(size, "<u8")
    return [None if n else d for d, n in zip(doc_ids, null)], lengths, unpack(words, offsets, count)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``text`` of every row, append ``end_id``, write files in order of ``doc_id``.

    Returns a table of files: ``file``, ``start`` (ids in all files before) and ``ids``. A
    null text is empty; null document ids come first; equal ids are ordered by a hash of
    the text. ``tokenizer_path`` must exist on every executor.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "tokens")
    whole = spark.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        encode, part, files = pieces(tokenizer_path, whole.value).ids, TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        chunks: list[np.ndarray] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            nonlocal files, waiting
            file = f"{folder}/{part:06d}-{files:06d}-{uuid.uuid4().hex}.tokens"
            with system.open_output_stream(open_folder(file)[1], compression=None) as stream:
                write_file(stream, doc_ids, np.concatenate(lengths), np.concatenate(chunks))
            row = pa.record_batch([[part], [files], [file], [waiting]], names=["part", "seq", "file", "ids"])
            doc_ids.clear(), lengths.clear(), chunks.clear()
            files, waiting = files + 1, 0
            return row.cast(pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("ids", pa.int64())]))

        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for low, high in row_slices(offsets):
                ids, sizes = encode(batch.column("text").slice(low, high - low))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                doc_ids += batch.column("doc_id").slice(low, high - low).to_pylist()
                lengths.append(sizes + 1)
                chunks.append(ids)
                waiting += len(ids)
                if waiting >= FILE_IDS:
                    yield flush()
        if waiting:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    files = stored(ordered.mapInArrow(write, "part int, seq int, file string, ids bigint"), "token-files")
    # One number per partition of the sort.
    sums = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("ids").alias("n")).collect()}
    parts = sorted(sums)
    starts = list(zip(parts, accumulate((sums[p] for p in parts), initial=0)))
    before = spark.createDataFrame(starts, "part int, before bigint")
    running = Window.partitionBy("part").orderBy("seq")
    start = F.col("before") + F.sum("ids").over(running) - F.col("ids")
    return files.join(F.broadcast(before), "part").select("file", start.alias("start"), "ids")


def token_counts(docs: DataFrame, tokenizer_path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``n_tokens``, the number of ids of the whole text with its end id, of every row."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def count(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(pieces(tokenizer_path, whole.value).counts(texts) + 1)]

    return add_from_text(docs, {"n_tokens": "bigint"}, count, keep)


def read_tokens(files: DataFrame, ids: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``."""
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if ids:
        kinds.append(("ids", pa.list_(pa.int64())))
        ddl += ", ids array<bigint>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(*(batch.column(c).to_pylist() for c in ("file", "start"))):
                system, path = open_folder(file)
                with system.open_input_stream(path, compression=None) as stream:
                    doc_ids, lengths, found = read_file(stream.read())
                ends = np.cumsum(lengths)
                data = memoryview(found.astype("<u4")).cast("B")
                bounds = list(zip((ends - lengths).tolist(), ends.tolist()))
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in bounds]
                columns = [doc_ids, first + ends - lengths, lengths, crc]
                if ids:
                    columns.append([found[a:b].astype(np.int64) for a, b in bounds])
                yield pa.record_batch(
                    [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds)], names=[n for n, _ in kinds]
                )

    tasks = max(1, min(TASKS, files.count()))
    return files.select("file", "start").repartition(tasks).mapInArrow(read, ddl)
