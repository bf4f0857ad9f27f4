"""Model features and the bands of the model's score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The model's inputs in order, the ordinal risk codes, the band cuts.
FEATURES = [
    "daily_watch_time_min",
    "watch_time_7d_min",
    "watch_time_30d_min",
    "active_days_7",
    "active_days_30",
    "days_since_last_login",
    "watch_time_ratio",
    "active_days_ratio",
    "risk_level_encoded",
]
RISK_CODES = {"Active": 0, "Soft Churn": 1, "Dormant": 2, "Churned": 3}
BAND_CUTS = {"Low": 0.44, "Mid": 0.51, "High": 0.55}
TOP_BAND = "Critical"
NO_BAND = "Unknown"


def probability_band(score: Column, cuts: dict[str, float] = BAND_CUTS) -> Column:
    """The band of a score; each cut is the open upper end of its band.

    NaN sorts above every number in Spark, so it is caught before the cuts.
    """
    band = F.when(score.isNull() | F.isnan(score), NO_BAND)
    for name, upper in cuts.items():
        band = band.when(score < upper, name)
    return band.otherwise(TOP_BAND)


def feature_ratios(df: DataFrame) -> DataFrame:
    """Last week against the average week of the last 30 days, in minutes and days."""
    return df.withColumns(
        {
            "watch_time_ratio": _weekly_ratio("watch_time_7d_min", "watch_time_30d_min"),
            "active_days_ratio": _weekly_ratio("active_days_7", "active_days_30"),
        }
    )


def _weekly_ratio(week: str, month: str) -> Column:
    return F.try_divide(F.col(week).cast("double"), F.col(month).cast("double") / 4 + 1)


def encode_risk(
    df: DataFrame,
    strict: bool = False,
    column: str = "churn_risk_level",
    out: str = "risk_level_encoded",
) -> DataFrame:
    """Ordinal risk code. Null and unknown levels give 0, or fail when ``strict``."""
    level = F.col(column)
    codes = F.create_map(*(F.lit(part) for pair in RISK_CODES.items() for part in pair))
    if strict:
        shown = F.coalesce(level, F.lit("null"))
        other = F.raise_error(F.concat(F.lit(f"{column} is not a known level: "), shown)).cast("int")
    else:
        other = F.lit(0)
    return df.withColumn(out, F.coalesce(F.try_element_at(codes, level), other))


def clean_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and infinite values become 0."""
    return df.withColumns({name: _finite_or_zero(df, name) for name in columns})


def _finite_or_zero(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.coalesce(value, F.lit(0).cast(df.schema[name].dataType))
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, 0.0).otherwise(value)


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``keep`` and the expected features in order; absent ones are 0."""
    present = set(df.columns)
    return df.select(
        *keep, *(F.col(n) if n in present else F.lit(0.0).alias(n) for n in expected)
    )


def segment_onehot(
    df: DataFrame, values: Sequence[str], column: str = "segment", prefix: str = "seg"
) -> DataFrame:
    """One 0/1 column per given value in place of ``column``; null and others are 0 in all.

    The values are those the model was trained on, so the columns do not depend on
    the data of the day.
    """
    flags = {
        f"{prefix}_{value}": F.coalesce((F.col(column) == value).cast("int"), F.lit(0))
        for value in values
    }
    return df.withColumns(flags).drop(column) if flags else df.drop(column)


def features(df: DataFrame, strict: bool = False) -> DataFrame:
    """All model inputs, finite and not null. ``strict`` is the serving variant."""
    return clean_features(encode_risk(feature_ratios(df), strict), FEATURES)
