"""Counts, distributions and classifier metrics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.ordering import exact_percentiles

PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def describe_scores(df: DataFrame, column: str = "churn_probability") -> DataFrame:
    """One row: count, mean, sample deviation, extremes and exact percentiles."""
    score = F.col(column)
    clean = df.filter(score.isNotNull() & ~F.isnan(score))
    marks = exact_percentiles(df, column, list(PERCENTILES.values()))
    return clean.agg(
        F.count(score).alias("count"),
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"),
        *(F.lit(mark).cast("double").alias(name) for name, mark in zip(PERCENTILES, marks)),
        F.max(score).alias("max"),
    )


def class_weight(df: DataFrame, label: str = "label", factor: float = 1.0) -> DataFrame:
    """One row: negatives, positives, and the weight a positive gets."""
    negatives = F.count_if(F.col(label) == 0)
    positives = F.count_if(F.col(label) == 1)
    return df.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        (F.try_divide(negatives, positives) * factor).alias("pos_weight"),
    )


def threshold_metrics(
    df: DataFrame, threshold: float = 0.5, score: str = "churn_probability", label: str = "label"
) -> DataFrame:
    """One row: recall and precision where only scores above ``threshold`` count."""
    hit = F.col(score) > threshold
    true = F.col(label) == 1
    tp, fp, fn = F.count_if(hit & true), F.count_if(hit & ~true), F.count_if(~hit & true)
    zero = F.lit(0.0)
    return df.agg(
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
    )


def auc_roc(df: DataFrame, score: str = "churn_probability", label: str = "label") -> float:
    """Exact area under the ROC curve, ties sharing their rank; NaN with one class.

    The area is the share of (positive, negative) pairs in the right order. Rows
    are counted per score and range-sorted; each task then counts the ordered
    pairs inside its own range, and the pairs across ranges follow from the
    ranges' totals. One row per task reaches the driver.
    """
    scored = df.filter(F.col(score).isNotNull())
    per_score = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("pos"),
        F.count_if(F.col(label) == 0).cast("double").alias("neg"),
    )
    ranges = per_score.orderBy("score").mapInArrow(
        _ordered_pairs(), "first double, pos double, neg double, pairs double"
    )
    pairs = positives = negatives = 0.0
    for part in sorted(ranges.collect(), key=lambda row: row["first"]):
        pairs += part["pairs"] + part["pos"] * negatives
        positives += part["pos"]
        negatives += part["neg"]
    total = positives * negatives
    return pairs / total if total else float("nan")


def _ordered_pairs():
    # A local function, so that executors need not have this package.
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, positives, negatives, pairs = None, 0.0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            score, pos, neg = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            first = score[0] if first is None else first
            below = negatives + neg.cumsum() - neg
            pairs += float((pos * (below + neg / 2)).sum())
            positives += float(pos.sum())
            negatives += float(neg.sum())
        if first is not None:
            names = ["first", "pos", "neg", "pairs"]
            row = [pa.array([value], pa.float64()) for value in (first, positives, negatives, pairs)]
            yield pa.RecordBatch.from_arrays(row, names)

    return summarise


def auc_pr(df: DataFrame, score: str = "churn_probability", label: str = "label") -> float:
    """Exact area under the precision-recall curve."""
    # Counting rows per score first leaves the evaluator's sort with distinct
    # scores only, however many rows share one.
    per_score = df.groupBy(
        F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label")
    ).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score",
        labelCol="label",
        weightCol="weight",
        metricName="areaUnderPR",
        numBins=0,
    )
    return evaluator.evaluate(per_score)
