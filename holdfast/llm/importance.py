"""Resampling documents towards a target distribution of hashed word runs.

1. Runs of 1 to 3 words are hashed into buckets; each task counts its documents' buckets, and
   the sums of corpus and target give each bucket's gain, one array of fixed size.
2. A document's weight is the sum of its features' gains, taken from that array. Its score adds
   Gumbel noise that only the seed and its id decide, so that the highest scores are a draw
   without replacement in proportion to the weights. Scores are written without the texts.
3. The cut-off is found by bisection of the score's range: exact counts over the written
   scores, those of the next four halvings in one job. Ties at the cut-off are cut in the same way by id, then
   by row number. No row is sorted for this, and one number a midpoint reaches the driver.
4. The rows drawn are range-partitioned by score and id, and numbered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm import bytewords
from holdfast.llm.columns import add_from_text
from holdfast.llm.store import stored
from holdfast.operators.ordering import with_row_index

BUCKETS, LONGEST, LEAST_WORDS = 10_000, 3, 20
_HALVINGS = 4  # levels of the bisection whose midpoints one job counts
_NO_ID = (1 << 63) - 1

_WORD = bytewords.byte_class("0123456789abcdefghijklmnopqrstuvwxyz")


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all rows of ``text`` by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for found in bytewords.words(batch.column("text"), _WORD, LONGEST - 1):
                for _, crc in bytewords.run_crcs(found, LONGEST):
                    total += np.bincount(crc % BUCKETS, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():  # at most BUCKETS
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed target share over the corpus share) of each bucket."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    shares = (float(t + 1) * s_all / (float(s + 1) * t_all) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(share)) for share in shares], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths; a null id is the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def _weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def compute(texts: pa.Array) -> list[pa.Array]:
        n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
        for found in bytewords.words(texts, _WORD, LONGEST - 1):
            rows = slice(found.row, found.row + len(found.bounds) - 1)
            count, value = np.zeros(len(found.start) + 1, np.int64), np.zeros(len(found.start) + 1, np.int64)
            for n, (last, crc) in enumerate(bytewords.run_crcs(found, LONGEST)):
                value[last] += shared.value[crc % BUCKETS]
                count[last] += 1
                if not n:
                    n_words[rows] += _sums(count, found.bounds)
            n_features[rows] += _sums(count, found.bounds)
            weight[rows] += _sums(value, found.bounds)
        return [pa.array(n_words), pa.array(n_features), pa.array(weight)]

    return add_from_text(docs, {"n_words": "bigint", "n_features": "bigint", "weight": "bigint"}, compute, ["doc_id"])


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[bounds])


def least_reaching(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """The least value v of the integer column for which ``wanted`` rows have values up to v, and the rows below v.

    There have to be so many rows. Bisection: the range is halved until one value is left.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0
    while low < high:
        edges = [low - 1, high]
        for _ in range(_HALVINGS):
            edges = sorted({*edges, *((a + b) // 2 for a, b in zip(edges, edges[1:]))})
        inner = edges[1:-1]
        counts = [*rows.agg(*(F.count_if(F.col(key) <= e) for e in inner)).first()]
        k = next((k for k, n in enumerate(counts) if n >= wanted), len(inner))
        below = counts[k - 1] if k else below
        low, high = edges[k] + 1, edges[k + 1]
    return low, below


def _first(rows: DataFrame, keys: list[str], wanted: int) -> Column:
    """Which rows are the first ``wanted`` (at least one) in the order of all keys."""
    tied, parts = [], []
    for key in keys:
        found = rows.filter(reduce(Column.__and__, tied)) if tied else rows
        value, below = least_reaching(found, key, wanted)
        parts.append(reduce(Column.__and__, [*tied, F.col(key) < value]))
        tied.append(F.col(key) == value)
        wanted -= below
    return reduce(Column.__or__, [*parts, reduce(Column.__and__, tied)])


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (5, 100),
    least_words: int = LEAST_WORDS,
    seed: int = 42,
) -> DataFrame:
    """Every row of ``docs`` with ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text, A-Z lower-cased; features
    are runs of up to three. The floor(share * n) highest scores of the n rows with ``least_words``
    words or more are drawn and ranked from 1, equal scores by the smaller id; the others' rank is
    null. A null or empty text has no features and weight 0, here and in ``target``; an empty
    target gives gains by the corpus alone. A null id draws noise of its own and is last among equal scores.
    Repeated rows are rows of their own and take ranks one after the other; an empty table gives none. Other
    columns are left out, whatever their names.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = _weigh(docs.select(F.col("doc_id").cast("bigint"), "text"), gain)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumns(
        {
            "down": -F.col("score"),
            "id": F.coalesce("doc_id", F.lit(_NO_ID)),
            "row": F.monotonically_increasing_id(),
        }
    )
    scored = stored(scored, "scores")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    wanted = share[0] * scored.filter(able).count() // share[1]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    keys = ["down", "id", "row"]
    drawn = able & _first(scored.filter(able), keys, wanted)
    ranked = with_row_index(scored.filter(drawn).select(*columns, *keys), keys, out="rank")
    others = scored.filter(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*columns, (F.col("rank") + 1).alias("rank")).unionByName(others)
