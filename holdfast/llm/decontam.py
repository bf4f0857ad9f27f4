"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is found in a document if the document holds at least ``PERCENT`` percent of the
item's distinct five-word shingles. Items are partitioned by size, in powers of two. All
items of a partition get a MinHash sketch of one length, their smallest shingle hashes:
one more than an item of the partition's largest size may miss. A document that holds
enough of an item therefore holds at least one hash of its sketch, whatever the
document's own size. Candidates are verified by the exact intersection of shingle sets.

An item of one to four words is looked for as a run of its own length.

Documents are scanned twice. The first scan looks their shingle hashes up in the sketches, of
which only (hash, item) rows are broadcast, dealt by hash into blocks of at most ``BLOCK_KEYS``;
a larger benchmark takes one pass over the documents for each block. The second reads the
candidates' texts again and compares full sets, which come from the stored items by an
ordinary join, so neither the size of an item nor their number has to fit a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import stored

SHINGLE, PERCENT = 5, 80
BLOCK_KEYS = 1_000_000  # 16 bytes each, and as many again in the table that is broadcast


def word_list(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text; none for null."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.array_remove(split, "")


def _runs(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, fewer than a shingle has."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.lit(0), F.size(words) - (size - 1))),
        lambda _, i: F.xxhash64(F.concat_ws(" ", F.slice(words, i + 1, size)), F.lit(size)),
    )


def with_shingles(df: DataFrame, text: str, out: str, runs: Sequence[int] | None = None) -> DataFrame:
    """Add the shingle hashes as an array.

    Fewer words than five are one shingle or, with ``runs``, nothing; these lengths' runs are then
    added for every text.
    """
    listed = df.withColumn("_words", word_list(F.col(text)))
    w = F.col("_words")
    several = F.transform(
        F.slice(w, 1, F.size(w) - (SHINGLE - 1)),
        lambda first, i: F.xxhash64(first, *(F.get(w, i + k) for k in range(1, SHINGLE))),
    )
    none = F.array().cast("array<bigint>")
    if runs is None:
        one = F.array(F.xxhash64(F.concat_ws(" ", w), F.size(w)))
        shingles = F.when(F.size(w) >= SHINGLE, several).when(F.size(w) > 0, one).otherwise(none)
    else:
        shingles = F.when(F.size(w) >= SHINGLE, several).otherwise(none)
        if runs:
            shingles = F.concat(shingles, *(_runs(w, size) for size in runs))
    return listed.withColumn(out, shingles).drop("_words")


def sketch_items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``words`` (up to five count), ``shingles`` (distinct, sorted) and ``sketch`` of every item with words."""
    counted = benchmark.select("item_id", "text", F.least(F.lit(SHINGLE), F.size(word_list(F.col("text")))).alias("words"))
    # Filtered before the shingles are made: a filter by them would be moved below them and make them again.
    items = counted.filter("words > 0")
    listed = with_shingles(items, "text", "hashes")
    items = listed.select("item_id", "words", F.array_sort(F.array_distinct("hashes")).alias("shingles"))
    # The largest size of the item's partition, and how many of its shingles may be missed.
    largest = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles"))))
    missed = F.floor(largest * (100 - PERCENT) / 100).cast("int")
    sketch = F.slice("shingles", 1, F.least(missed + 1, F.size("shingles")))
    return items.withColumn("sketch", sketch)


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id``, ``n_shingles``, ``n_found``.

    A null or empty text holds nothing, an item without words is never found, and an item
    of fewer than five words where its words follow each other. Repeated rows count once
    per ``doc_id`` and ``item_id`` (with the largest ``n_found``); null ids are kept. Only the four
    columns are read, so others may have any name.
    """
    items = stored(sketch_items(benchmark).withColumn("item", F.monotonically_increasing_id()), "benchmark-sketches")
    short = sorted(r["words"] for r in items.filter(F.col("words") < SHINGLE).select("words").distinct().collect())
    # Equal texts of one id are one document; two hashes stand for the text.
    texts = docs.select("doc_id", "text").withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64("text", F.lit(1))})
    hashed = with_shingles(texts, "text", "hashes", short).drop("text")
    keys = items.select("item", F.explode("sketch").alias("key"))
    blocks = max(1, ceil(keys.count() / BLOCK_KEYS))
    document = ["doc_id", "t1", "t2"]
    hits = []
    for i in range(blocks):
        block = keys.filter(F.pmod(F.xxhash64("key", "item"), F.lit(blocks)) == i)
        # explode_outer, as for explode Spark filters by size below the projection of the words
        # and would split the text anew for every shingle.
        each = hashed.select(*document, F.explode_outer("hashes").alias("key"))
        hits.append(each.join(F.broadcast(block), "key").select(*document, "item"))
    candidates = reduce(DataFrame.unionAll, hits).distinct().toDF("hit_id", "hit_t1", "hit_t2", "item")
    same = [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(document, ("hit_id", "hit_t1", "hit_t2"))]
    met = texts.join(candidates, reduce(Column.__and__, same)).select("doc_id", "text", "item")
    full = with_shingles(met, "text", "hashes", short).drop("text")
    verified = full.join(items.select("item", "item_id", "shingles"), "item").select(
        "doc_id",
        "item_id",
        F.size("shingles").alias("n_shingles"),
        F.size(F.array_intersect("shingles", "hashes")).alias("n_found"),
    )
    found = verified.filter(100 * F.col("n_found") >= PERCENT * F.col("n_shingles"))
    return found.groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_found").alias("n_found"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; those with a null id are judged by their text too."""
    named = docs.withColumn("_row", F.struct(*docs.columns))
    key = F.xxhash64("doc_id", "text")
    keyed = named.select(F.struct("doc_id", key.alias("text_key")).alias("doc_id"), "text", "_row")
    bad = find_items(keyed, benchmark).select(F.col("doc_id.doc_id").alias("a"), F.col("doc_id.text_key").alias("b"))
    clean = keyed.join(
        bad.distinct(), F.col("doc_id.doc_id").eqNullSafe(F.col("a")) & (F.col("doc_id.text_key") == F.col("b")), "left_anti"
    )
    return clean.select("_row.*")
