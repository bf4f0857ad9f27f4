"""Packing by optimal length buckets.

A global histogram of lengths is reduced to cells: lengths up to ``EXACT`` each have their
own, beyond it every doubling has ``PER_DOUBLING`` (so cells are bounded for any input).
Dynamic programming over the cells chooses at most ``buckets`` upper bounds that minimise
the padding when each text is padded to its bucket's bound, which is the largest length
that occurs in it. Within a bucket, batches of equal shape hold as many texts as the
token budget allows.

Rows of a bucket are dealt at random into shards of about ``SHARD_ROWS`` and numbered inside
them, so a bucket with a third of all rows is spread; each shard ends with one batch
that may not be full. A text longer than the budget is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.columns import unused
from holdfast.llm.decontam import word_list
from holdfast.llm.store import stored
from holdfast.llm.tokens import token_counts

EXACT, PER_DOUBLING = 4_096, 128
BUCKETS, TOKEN_BUDGET, SHARD_ROWS = 16, 65_536, 20_000


def cell(length: Column) -> Column:
    """The least length of the histogram cell that ``length`` is in."""
    # With e = floor(log2(length)), cells beyond EXACT are 2**e / PER_DOUBLING wide.
    doubling = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int")
    width = F.greatest(F.lit(1), F.call_function("div", F.call_function("shiftleft", F.lit(1).cast("bigint"), doubling), F.lit(PER_DOUBLING)))
    rounded = F.floor(length / width).cast("bigint") * width
    return F.when(length <= EXACT, length).otherwise(rounded)


def choose_bounds(longest: Sequence[int], count: Sequence[int], total: Sequence[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over cells in ascending order.

    ``longest``, ``count`` and ``total``: largest length, texts and sum of lengths per cell.
    """
    cells = len(longest)
    if not cells:
        return []
    cap = np.asarray(longest, np.float64)
    texts = np.concatenate(([0.0], np.cumsum(np.asarray(count, np.float64))))
    tokens = np.concatenate(([0.0], np.cumsum(np.asarray(total, np.float64))))
    best = np.full(cells + 1, np.inf)  # least padding of the first cells
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, cells)):
        fresh, cut = best.copy(), np.full(cells + 1, -1)
        base = best + tokens
        for j in range(1, cells + 1):
            padded = base[:j] - cap[j - 1] * texts[:j]
            i = int(padded.argmin())
            value = padded[i] + cap[j - 1] * texts[j] - tokens[j]
            if value < fresh[j]:
                fresh[j], cut[j] = value, i
        cuts.append(cut)
        best = fresh
    bounds, end = [], cells
    for cut in reversed(cuts):
        if end and cut[end] >= 0:
            bounds.append(int(longest[end - 1]))
            end = int(cut[end])
    return sorted(bounds)


def pack(
    docs: DataFrame,
    length: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per row of ``docs``: ``keep``, ``length``, ``bucket``, ``shard``, ``batch``, ``slot``.

    ``length`` is a column, by default the number of words of ``text``; null counts as 0.
    ``bucket`` is the length that the text is padded to; (``bucket``, ``shard``, ``batch``) names
    a batch and ``slot`` the place in it. bucket times texts of a batch stays within
    ``budget`` unless the batch is a single text. Empty texts and repeated rows get places
    of their own; an empty table gives none.
    """
    keep = [c for c in keep if c not in ("length", "bucket", "shard", "batch", "slot")]
    size_col, room_col, at_col = (unused(c, [*keep, "bucket", "shard"]) for c in ("size", "room", "at"))
    value = F.size(word_list(F.col("text"))) if length is None else length
    sized = docs.select(*keep, F.coalesce(value, F.lit(0)).cast("bigint").alias(size_col))
    histogram = (
        sized.groupBy(cell(F.col(size_col)).alias("cell"))
        .agg(F.max(size_col).alias("longest"), F.count(F.lit(1)).alias("n"), F.sum(size_col).alias("total"))
        .orderBy("cell")
        .collect()  # a bounded number of cells
    )
    bounds = choose_bounds(*([r[c] for r in histogram] for c in ("longest", "n", "total")), buckets)
    texts = {b: 0 for b in bounds}
    for row in histogram:
        texts[next(b for b in bounds if row["longest"] <= b)] += row["n"]
    room = {b: max(1, budget // max(b, 1)) for b in bounds}

    def by_bucket(values: dict[int, int]) -> Column:
        chosen = F.lit(None).cast("bigint")
        for bound in reversed(bounds):
            chosen = F.when(F.col(size_col) <= bound, F.lit(values[bound]).cast("bigint")).otherwise(chosen)
        return chosen

    shards = {b: -(-texts[b] // max(SHARD_ROWS, room[b])) for b in bounds}
    places = sized.withColumns(
        {
            "bucket": by_bucket({b: b for b in bounds}),
            room_col: by_bucket(room),
            "shard": F.floor(F.rand(seed=8) * by_bucket({b: max(1, s) for b, s in shards.items()})).cast("int"),
        }
    )
    order = Window.partitionBy("bucket", "shard").orderBy(size_col, *keep)
    numbered = places.withColumn(at_col, F.row_number().over(order) - 1)
    return numbered.select(
        *keep,
        F.col(size_col).alias("length"),
        "bucket",
        "shard",
        F.floor(F.col(at_col) / F.col(room_col)).cast("bigint").alias("batch"),
        (F.col(at_col) % F.col(room_col)).cast("int").alias("slot"),
    )


def pack_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``pack`` by tokens: ``length`` is the number of ids of the whole text and its end id.

    Texts are encoded once; ``keep`` and the counts are written, as packing reads them twice.
    """
    counts = stored(token_counts(docs, tokenizer_path, keep), "token-counts")
    return pack(counts, F.col("n_tokens"), buckets, budget, [c for c in keep if c != "n_tokens"])
