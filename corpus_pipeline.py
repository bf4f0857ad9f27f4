"""The corpus pipeline: every stage is one operator, its result is the next stage's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from holdfast.llm import decontam, neardup, packing, quality, substrings
from holdfast.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality label is 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(docs, labels)
    return quality.score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return neardup.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows, ``n_chars`` brought up to date.

    A text that loses no word stays as it is, white space included.
    """
    changed = substrings.remove_repeats(docs, leave=True, is_scan=True)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in batches of their length buckets, by tokens."""
    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near-duplicates", one_of_each),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", batches),
]

ORACLE_SQL = None  # the classifier is a trained model; tests check planted cases


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
