import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from holdfast.functions import scores


def test_bands_at_the_cuts(spark):
    values = [0.1, 0.44, 0.509, 0.51, 0.55, 1.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    bands = [r.b for r in df.select(scores.probability_band(F.col("p")).alias("b")).collect()]
    assert bands == ["Low", "Mid", "Mid", "High", "Critical", "Critical", "Unknown", "Unknown"]


def test_bands_take_other_cuts(spark):
    df = spark.createDataFrame([(0.2,), (0.9,)], "p double")
    band = scores.probability_band(F.col("p"), {"Low": 0.5})
    assert [r.b for r in df.select(band.alias("b")).collect()] == ["Low", "Critical"]


LEVELS = "churn_risk_level string"


def test_risk_codes_follow_severity(spark):
    levels = ["Active", "Soft Churn", "Dormant", "Churned"]
    df = scores.encode_risk(spark.createDataFrame([(v,) for v in levels], LEVELS), strict=True)
    assert [r.risk_level_encoded for r in df.collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("level", [None, "Gone"])
def test_risk_level_unknown_or_null(spark, level):
    df = spark.createDataFrame([(level,)], LEVELS)
    assert scores.encode_risk(df).first().risk_level_encoded == 0
    with pytest.raises(PySparkException, match="not a known level"):
        scores.encode_risk(df, strict=True).collect()


def test_ratio_survives_a_zero_denominator(spark):
    df = spark.createDataFrame(
        [(7.0, 28.0, 3, 8), (5.0, -4.0, 1, -4), (None, 4.0, None, 4)],
        "watch_time_7d_min double, watch_time_30d_min double, active_days_7 long, active_days_30 long",
    )
    out = scores.clean_features(scores.feature_ratios(df), ["watch_time_ratio", "active_days_ratio"])
    found = [(r.watch_time_ratio, r.active_days_ratio) for r in out.collect()]
    assert found == [(7 / 8, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_clean_features(spark):
    values = [1.5, None, math.nan, math.inf, -math.inf]
    df = spark.createDataFrame([(v, None) for v in values], "x double, n int")
    rows = scores.clean_features(df, ["x", "n"]).collect()
    assert [(r.x, r.n) for r in rows] == [(1.5, 0), (0.0, 0), (0.0, 0), (0.0, 0), (0.0, 0)]


def test_align_features_orders_and_fills(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "user_id int, b double, a double")
    out = scores.align_features(df, ["a", "z", "b"], keep=["user_id"])
    assert out.columns == ["user_id", "a", "z", "b"]
    assert tuple(out.first()) == (1, 3.0, 0.0, 2.0)


def test_onehot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, segment string")
    out = scores.segment_onehot(df, ["a", "b"])
    assert out.columns == ["id", "seg_a", "seg_b"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    assert scores.segment_onehot(df.limit(0), ["a", "b"]).columns == out.columns
