from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators.aggregates import (
    auc_pr,
    auc_roc,
    class_weight,
    describe_scores,
    threshold_metrics,
    value_counts,
)
from holdfast.operators.ordering import _values_in_spans, exact_percentiles, row_at, with_row_index
from holdfast.operators.splits import split_for_training, stratified_split, time_split


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one date, a third with one score."""
    rnd = np.random.default_rng(7)
    data = []
    for user in range(900):
        n = 3 if rnd.random() < 0.33 else int(rnd.integers(0, 12))
        p = 0.25 if rnd.random() < 0.33 else float(rnd.random())
        data.append((user % 300, date(2024, 1, 1) + timedelta(days=n), user, p, int(rnd.random() < 0.2)))
    schema = "user_id long, event_date date, row long, p double, label int"
    return spark.createDataFrame(data, schema).repartition(6).cache()


def test_row_index_is_the_sorted_position(rows):
    out = with_row_index(rows, ["event_date"], ["user_id"]).toPandas().sort_values("row_index")
    assert list(out.row_index) == list(range(900))
    keys = list(zip(out.event_date, out.user_id))
    assert keys == sorted(keys)


def test_row_at(rows):
    values = sorted(r.p for r in rows.select("p").collect())
    for position in (0, 1, 450, 899):
        assert row_at(rows.select("p"), ["p"], position).p == values[position]
    assert row_at(rows.select("p"), ["p"], 900) is None


def test_percentiles_match_numpy(rows, spark):
    values = [r.p for r in rows.collect()]
    shares = [0, 0.25, 0.5, 0.75, 0.9, 1]
    assert np.allclose(exact_percentiles(rows, "p", shares), np.quantile(values, shares))
    some = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "p double")
    assert exact_percentiles(some, "p", [0.25, 0.9]) == [1.0, 1.0]
    assert exact_percentiles(some.limit(0), "p", [0.5]) == [None]


@pytest.mark.parametrize("spread", ["rand(3)", "round(rand(3), 2)", "if(rand(3) < 0.4, 0.5, rand(4))"])
def test_percentiles_of_many_rows(spark, spread):
    df = spark.range(0, 150_000, 1, 8).select(F.expr(spread).alias("p")).cache()
    values, shares = df.toPandas().p, [0, 0.25, 0.26, 0.5, 0.75, 0.9, 1]
    assert np.allclose(exact_percentiles(df, "p", shares), np.quantile(values, shares), rtol=1e-12)


def test_spans_that_miss_a_rank_are_noticed(rows):
    values = rows.select(F.col("p").alias("value"))
    assert _values_in_spans(values, [(0.0, 0.1)], [899]) is None
    assert np.allclose(exact_percentiles(rows, "p", [0.1, 0.9]), np.percentile([r["p"] for r in rows.collect()], [10, 90]))


def test_describe(rows, spark):
    report = describe_scores(rows, "p").first()
    values = np.array([r.p for r in rows.collect()])
    assert report["count"] == 900
    assert np.isclose(report["mean"], values.mean()) and np.isclose(report["std"], values.std(ddof=1))
    assert np.isclose(report["p90"], np.quantile(values, 0.9))
    empty = describe_scores(rows.limit(0), "p").first()
    assert empty["count"] == 0 and empty["p50"] is None


@pytest.mark.parametrize("share", [0.0, 0.37, 0.5, 0.8, 1.0])
def test_time_split_is_the_first_share(rows, share):
    parts = time_split(rows, share).toPandas()
    train, test = parts[parts.is_train], parts[~parts.is_train]
    assert len(train) == int(900 * share)
    if len(train) and len(test):
        key = ["event_date", "user_id"]
        assert max(map(tuple, train[key].values)) <= min(map(tuple, test[key].values))


def test_time_split_by_timestamp(spark):
    df = spark.range(1000).selectExpr("id as user_id", "timestamp_seconds(1704067200 + (id * 7919) % 1000 * 600) as ts")
    parts = time_split(df, 0.8, order="ts").toPandas()
    train, test = parts[parts.is_train], parts[~parts.is_train]
    assert len(train) == 800 and train.ts.max() < test.ts.min()


def test_rows_without_a_date_are_never_train(spark):
    df = spark.createDataFrame([(1, None), (2, date(2024, 1, 1)), (3, date(2024, 1, 2))], "user_id long, event_date date")
    assert {r.user_id for r in time_split(df, 1.0).filter("is_train").collect()} == {2, 3}
    assert {r.user_id for r in time_split(df, 0.4).filter("is_train").collect()} == {2}


def test_stratified_split_keeps_label_shares(rows):
    for label, part in stratified_split(rows).toPandas().groupby("label"):
        assert part.is_train.sum() == int(len(part) * 0.8)
    again = stratified_split(rows.repartition(3)).filter("is_train").select("row")
    assert {r.row for r in again.collect()} == {
        r.row for r in stratified_split(rows).filter("is_train").select("row").collect()
    }


def test_split_falls_back_when_train_lacks_a_class(rows):
    late = rows.withColumn("label", (F.col("event_date") >= "2024-01-12").cast("int"))
    parts = split_for_training(late).filter("is_train")
    assert {r.label for r in parts.select("label").distinct().collect()} == {0, 1}
    assert time_split(rows).exceptAll(split_for_training(rows)).count() == 0


def test_auc_matches_pairs(rows):
    data = rows.select("p", "label").toPandas()
    ones, zeros = data.p[data.label == 1].values, data.p[data.label == 0].values
    gaps = ones[:, None] - zeros[None, :]
    expected = ((gaps > 0).sum() + 0.5 * (gaps == 0).sum()) / gaps.size
    assert np.isclose(auc_roc(rows, "p"), expected)


def test_auc_with_one_class_or_one_score(rows, spark):
    assert np.isnan(auc_roc(rows.filter("label = 1"), "p"))
    assert auc_roc(rows.withColumn("p", F.lit(0.5)), "p") == 0.5
    perfect = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.9, 1), (None, 1)], "p double, label int")
    assert auc_roc(perfect, "p") == 1.0


def test_pr_area_of_a_perfect_ranking(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.9, 1), (0.8, 1)], "p double, label int")
    assert auc_pr(df, "p") == 1.0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame(
        [(0.5, 1), (0.6, 1), (0.9, 0), (0.1, 0)], "churn_probability double, label int"
    )
    assert tuple(threshold_metrics(df).first()) == (0.5, 0.5)
    assert tuple(threshold_metrics(df, 0.95).first()) == (0.0, 0.0)


def test_class_weight_and_counts(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "label int")
    assert tuple(class_weight(df, factor=2.0).first()) == (3, 1, 6.0)
    assert class_weight(df.filter("label = 0")).first()["pos_weight"] is None
    assert [tuple(r) for r in value_counts(df, "label").collect()] == [(0, 3), (1, 1)]
