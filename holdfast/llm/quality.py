"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent.

A text's features are its words, pairs of neighbouring words and character n-grams, each
hashed to a bucket. Every bucket has a learned vector; a text is the average of its
features' vectors, followed by a softmax over the labels. A pair is hashed from the
difference of its two words, so all pairs of equal words share one bucket: repetition is
a feature of its own.

Training runs on a bounded sample: the ``MAX_LABELLED`` labelled rows that come first by
hash of their id. Their texts become sparse bucket counts on the executors, whole texts
and all; only these counts, compressed, reach the driver. For scoring, vectors and output layer are
folded into one number per bucket, so a text's score is one lookup and one average.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.columns import add_from_text
from holdfast.llm.textarrays import code_points, gram_buckets, mix, row_slices, utf8, words

BITS = 16
CHARACTER_ORDERS = (3,)
DIMENSIONS = 8
MAX_LABELLED = 4_000
EPOCHS, RATE, SEED = 8, 2.0, 7


class QualityModel(NamedTuple):
    vectors: np.ndarray  # bucket x dimension
    output: np.ndarray  # dimension
    bias: float

    def folded(self) -> np.ndarray:
        """The share of each bucket in the log-odds of label 1."""
        return (self.vectors @ self.output).astype(np.float32)


def _features(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and row of every feature, one kind after the other."""
    found = words(data, offsets)
    shift = np.uint64(64 - BITS)
    yield (found.hashes >> shift).astype(np.int64), found.row
    same = found.row[1:] == found.row[:-1]
    pair = mix(found.hashes[1:] - found.hashes[:-1] + np.uint64(1)) >> shift
    yield pair[same].astype(np.int64), found.row[1:][same]
    points, bounds = code_points(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    for n in CHARACTER_ORDERS:
        bucket = gram_buckets(points, n, BITS)
        inside = row[: len(bucket)] == row[n - 1 :]
        yield bucket[inside].astype(np.int64), row[: len(bucket)][inside]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[str]]]:
    data, offsets = utf8(texts)
    for low, high in row_slices(offsets):
        part = data[offsets[low] : offsets[high]]
        strings = [t or "" for t in texts.slice(low, high - low).to_pylist()]
        yield low, high, part, offsets[low : high + 1] - offsets[low], strings


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _unpacked(buckets: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of one text as :func:`_bucket_counts` packs them."""
    gaps = np.frombuffer(zlib.decompress(buckets), np.uint16)
    return np.cumsum(gaps, dtype=np.uint16), np.frombuffer(zlib.decompress(counts), np.int32).astype(np.float32)


def _bucket_counts(texts: pa.Array) -> list[pa.Array]:
    """Each text's buckets, as gaps between them in ascending order, and its counts of them; both compressed."""
    buckets, counts = [], []
    for low, high, *parts in _slices(texts):
        joined = list(_features(*parts))
        bucket = np.concatenate([b for b, _ in joined])
        row = np.concatenate([r for _, r in joined])
        key, n = np.unique((row << BITS) + bucket, return_counts=True)
        ends = np.searchsorted(key, np.arange(1, high - low + 1) << BITS)
        key = key & ((1 << BITS) - 1)
        for start, end in zip([0, *ends[:-1]], ends):
            buckets.append(_packed(np.diff(key[start:end], prepend=0).astype(np.uint16)))
            counts.append(_packed(n[start:end].astype(np.int32)))
    return [pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())]


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learn from the texts of labelled rows; equal ids in ``labels`` are averaged.

    Null labels, ids and texts are left out; of repeated ids in ``docs`` the text with the
    smallest hash counts. Without any labelled row the model scores
    every text 0.5.
    """
    by_id = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    sample = (
        by_id.agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_LABELLED)
    )
    # At most MAX_LABELLED short rows, so broadcasting them is safe.
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # One row of each id, so the bound holds for rows and a repeated id has one vote.
    texts = rows.groupBy("doc_id", "_label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    kinds = {"buckets": "binary", "counts": "binary"}
    rows = add_from_text(texts, kinds, _bucket_counts, keep=["doc_id", "_label"]).toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    texts = [_unpacked(rows["buckets"][int(i)].as_py(), rows["counts"][int(i)].as_py()) for i in order]
    return train([bucket for bucket, _ in texts], [count for _, count in texts], rows["_label"].to_numpy()[order])


def train(bucket: list[np.ndarray], count: list[np.ndarray], label: np.ndarray) -> QualityModel:
    """Stochastic gradient descent, one text a step, with a rate that falls to zero."""
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros(DIMENSIONS, np.float32), 0.0
    weight = [c / c.sum() if len(c) else c for c in count]
    steps, done = EPOCHS * len(bucket), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(bucket)):
            rate = RATE * (1 - done / steps)
            done += 1
            rows, share = vectors[bucket[i]], weight[i]
            text = share @ rows if len(share) else np.zeros(DIMENSIONS, np.float32)
            error = label[i] - 1 / (1 + np.exp(-np.clip(text @ output + bias, -30, 30)))
            step = np.float32(rate * error)
            if len(share):
                # Average gradients are tiny per bucket; the share is scaled as in training by tokens.
                vectors[bucket[i]] = rows + step * np.sqrt(share)[:, None] * output
            output = output + step * text
            bias += 0.1 * float(step)
    return QualityModel(vectors, output, bias)


def score_quality(docs: DataFrame, model: QualityModel, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``score`` (probability of label 1) and ``predicted`` (1 from 0.5 on) to every row.

    Null and empty texts have no features and get the score of the bias. Repeated
    rows and other columns are kept; columns with one of the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.folded(), model.bias))

    def score(texts: pa.Array) -> list[pa.Array]:
        folded, bias = shared.value
        odds = np.zeros(len(texts))
        for low, high, *parts in _slices(texts):
            sums, counts = np.zeros(high - low), np.zeros(high - low)
            for bucket, row in _features(*parts):
                sums += np.bincount(row, folded[bucket], minlength=high - low)
                counts += np.bincount(row, minlength=high - low)
            odds[low:high] = sums / np.maximum(counts, 1) + bias
        value = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        return [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]

    return add_from_text(docs, {"score": "double", "predicted": "int"}, score, keep)
