"""Daily scoring of active users, and the report on a day's scores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.forest import Forest, score
from holdfast.functions.scores import align_features, features, probability_band
from holdfast.operators.aggregates import describe_scores, value_counts
from holdfast.operators.checks import require_columns, require_rows
from holdfast.operators.filters import active_on, pick_date
from holdfast.sources.publish import Expectation, no_null, none_where, rows_between
from holdfast.sources.registry import Signature

REQUIRED = [
    "user_id",
    "event_date",
    "is_active",
    "daily_watch_time_min",
    "watch_time_7d_min",
    "watch_time_30d_min",
    "active_days_7",
    "active_days_30",
    "days_since_last_login",
    "churn_risk_level",
]

def expectations(highest: float = 1.0) -> list[Expectation]:
    """What a published day of scores must hold; ``highest`` is above 1 only for scores that are no probabilities."""
    chance = F.col("churn_probability")
    return [
        rows_between(1),
        no_null("user_id"),
        none_where(f"probability outside 0 to {highest:g}", chance.isNull() | ~chance.between(0, highest)),
        none_where("unknown band", F.col("probability_band") == "Unknown"),
    ]


def expected_features(model: Forest) -> list[str]:
    """The features a model was trained on, in order."""
    return list(model.inputs)


def with_scores(active: DataFrame, model: Forest, signature: Signature | None = None) -> DataFrame:
    """Probability and band of each row; an unknown risk level fails the run.

    With a signature, inputs of other types fail before any task runs.
    """
    ready = align_features(
        features(active, strict=True), expected_features(model), keep=["user_id", "event_date"]
    )
    scored = score(signature.check_inputs(ready) if signature else ready, model)
    return (signature.check_outputs(scored) if signature else scored).select(
        "user_id",
        "event_date",
        "churn_probability",
        probability_band(F.col("churn_probability")).alias("probability_band"),
    )


def score_day(
    snapshot: DataFrame,
    model: Forest,
    day: date | str | None = None,
    as_of: date | None = None,
    signature: Signature | None = None,
) -> DataFrame:
    """Scores of the users active on one date (see :func:`pick_date`).

    Store the result with :func:`holdfast.sources.publish.publish_date` and
    :func:`expectations`.
    """
    require_columns(snapshot, REQUIRED)
    chosen = pick_date(snapshot, as_of, day)
    active = require_rows(active_on(snapshot, chosen), f"no active users on {chosen}")
    return with_scores(active, model, signature)


def score_report(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users per band, and the distribution of the probabilities."""
    return value_counts(scores, "probability_band"), describe_scores(scores)
