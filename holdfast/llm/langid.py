"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from all labelled texts: every task adds up n-grams per language and bucket
in numpy and hands on the sums, so what is shuffled does not grow with the texts. The
matrix of log probabilities has one row per bucket and one column per language; it is
broadcast (``MAX_CELLS`` is checked first), and texts are scored in batches by looking up
the rows of their n-grams and adding them per text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.columns import add_from_text
from holdfast.llm.store import stored
from holdfast.llm.textarrays import code_points, gram_buckets, is_letter, row_slices, utf8

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
LANGUAGES_AT_ONCE = 64  # more than these in one task: sums are handed on in between
MAX_CELLS = 16_000_000
UNKNOWN = "und"


class LanguageModel(NamedTuple):
    languages: list[str]
    prior: np.ndarray  # log share of the labelled texts
    weights: np.ndarray  # bucket x language, log probability


def _prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with one space for anything between; row offsets; has letters."""
    points, offsets = code_points([t.lower() for t in texts])
    letter = is_letter(points)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    keep[offsets[:-1]] = True
    some = np.add.reduceat(letter, offsets[:-1], dtype=np.int64) > 0
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    points = np.where(letter, points, np.uint32(32))[keep]
    return points, kept_before[offsets], some


def _grams(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket of each n-gram and its row, order by order."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in ORDERS:
        bucket = gram_buckets(points, n, BITS)
        inside = row[: len(bucket)] == row[n - 1 :]
        yield bucket[inside], row[: len(bucket)][inside]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    _, offsets = utf8(texts)
    for low, high in row_slices(offsets):
        yield low, high, [t or "" for t in texts.slice(low, high - low).to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    texts_of: dict[str, int] = {}

    def handed_on() -> pa.RecordBatch:
        kind = [pa.string(), pa.int32(), pa.int64()]
        columns: list[list] = [[], [], []]
        for name, dense in counts.items():
            used = np.flatnonzero(dense)
            columns[0] += [name] * (len(used) + 1)
            columns[1].append(np.concatenate((used, [-1])))
            columns[2].append(np.concatenate((dense[used], [texts_of[name]])))
        arrays = [columns[0], *(np.concatenate(c) if c else [] for c in columns[1:])]
        counts.clear(), texts_of.clear()
        return pa.record_batch(
            [pa.array(a, k) for a, k in zip(arrays, kind)], names=["lang", "bucket", "n"]
        )

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for low, high, texts in _slices(batch.column("text")):
            points, offsets, _ = _prepared(texts)
            names = sorted(set(langs[low:high]))
            code = np.array([names.index(x) for x in langs[low:high]])
            for name in names:
                counts.setdefault(name, np.zeros(1 << BITS, np.int64))
                texts_of[name] = texts_of.get(name, 0) + langs[low:high].count(name)
            for bucket, row in _grams(points, offsets):
                sums = np.bincount((code[row] << BITS) + bucket, minlength=len(names) << BITS)
                for i, name in enumerate(names):
                    counts[name] += sums[i << BITS : (i + 1) << BITS]
            if len(counts) > LANGUAGES_AT_ONCE:
                yield handed_on()
    if counts:
        yield handed_on()


def fit_languages(docs: DataFrame) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of all rows where neither is null."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = labelled.mapInArrow(_count, "lang string, bucket int, n bigint")
    cells = stored(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    most = MAX_CELLS // (1 << BITS)
    # One more than fit, so that too many are noticed before any cell comes to the driver.
    languages = sorted(row[0] for row in cells.filter("bucket = -1").select("lang").limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages do not fit the broadcast matrix")
    table = cells.toArrow()
    at = np.searchsorted(languages, np.array(table["lang"].to_pylist(), dtype=object)) if languages else []
    bucket, n = (table[c].to_numpy() for c in ("bucket", "n"))
    dense = np.zeros((1 << BITS, len(languages)))
    sums = np.zeros(len(languages))
    if languages:
        real = bucket >= 0
        dense[bucket[real], at[real]] = n[real]
        sums[at[~real]] = n[~real]
    smooth = dense + SMOOTHING
    weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    return LanguageModel(languages, np.log(sums / sums.sum()) if languages else sums, weights)


def score_texts(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the most likely language and its probability; -1 without a letter."""
    points, offsets, some = _prepared(texts)
    total = np.tile(model.prior, (len(texts), 1))
    for bucket, row in _grams(points, offsets):
        if len(row):
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            total[row[starts]] += np.add.reduceat(model.weights[bucket], starts, axis=0, dtype=np.float64)
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return np.where(some, best, -1), np.where(some, share, 0.0)


def predict_languages(
    docs: DataFrame, model: LanguageModel, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, from ``text`` alone.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, and
    for all rows when nothing was learned. Ties go to the first language by name.
    Repeated rows, long texts and other columns are kept as they are; columns that
    have one of the two names are replaced. ``keep`` names the columns to return.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(column: pa.Array) -> list[pa.Array]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        best, share = np.full(len(column), -1), np.zeros(len(column))
        if model.languages:
            for low, high, texts in _slices(column):
                best[low:high], share[low:high] = score_texts(texts, model)
        return [pa.array(names[best], pa.string()), pa.array(share)]

    return add_from_text(docs, {"lang_pred": "string", "score": "double"}, predict, keep)
