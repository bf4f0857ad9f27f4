"""One query per operator, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from holdfast.llm import ann, decontam, divergence, importance, langid, neardup, packing, quality, substrings, tokencounts, tokens, urls, warc

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    """Every page's url against the rules."""
    judged = urls.judge_urls(_table(spark, directory, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_warc_revisits(spark: SparkSession, directory: str) -> DataFrame:
    """Every page as a record of the archives, repeated payloads as revisits."""
    headers = warc.write_archives(_table(spark, directory, "pages"))
    files = warc.rewrite_archives(warc.resolve(headers))
    records = warc.read_archives(files, payloads=False)
    return warc.with_originals(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _fold(parts: int) -> Column:
    """Remainder of the crc32 of the id's text."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op3_language_id(spark: SparkSession, directory: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    docs = _table(spark, directory, "documents").withColumn("held_out", F.coalesce(_fold(5) == 0, F.lit(False)))
    model = langid.fit_languages(docs.filter(~F.col("held_out")))
    return langid.predict_languages(docs, model, keep=["doc_id", "held_out"])


def op4_quality(spark: SparkSession, directory: str) -> DataFrame:
    """Quality of every text, learned from labels that are not held out."""
    docs = _table(spark, directory, "documents").withColumn("held_out", F.coalesce(_fold(3) == 1, F.lit(False)))
    labels = _table(spark, directory, "labels").filter(_fold(3) != 1)
    model = quality.fit_quality(docs, labels)
    return quality.score_quality(docs, model, keep=["doc_id", "held_out"])


def op5_simple8b_tokens(spark: SparkSession, directory: str) -> DataFrame:
    """Token ids of every document, written to files and read back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.read_tokens(tokens.write_tokens(_table(spark, directory, "documents"), path))


def op6_hyperminhash(spark: SparkSession, directory: str) -> DataFrame:
    """Every document with its component of near-duplicates."""
    return neardup.near_duplicates(_table(spark, directory, "documents"), percent=85)


def op7_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Every document without the words of repeated windows."""
    kept = substrings.remove_repeats(_table(spark, directory, "documents"), keep=["doc_id"], is_scan=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_length_buckets(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's place in the batches of its length bucket, by tokens."""
    return packing.pack_tokens(_table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_multi_index_hashing(spark: SparkSession, directory: str) -> DataFrame:
    """The 20 nearest other vectors of every twentieth vector."""
    vectors = _table(spark, directory, "embeddings")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op10_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return decontam.find_items(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))


def op11_source_divergence(spark: SparkSession, directory: str) -> DataFrame:
    """Every source's most distinct terms, and its distance from the other sources of its language."""
    return divergence.audit_sources(_table(spark, directory, "documents"))


def op12_importance_resampling(spark: SparkSession, directory: str) -> DataFrame:
    """A twentieth of the documents, drawn towards the benchmark's distribution, with ranks."""
    drawn = importance.resample(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_whole_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Bytes and tokens of every document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokencounts.count_tokens(_table(spark, directory, "documents"), path, keep=["doc_id"])


def llm_queries() -> dict[str, Query]:
    named = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return named
