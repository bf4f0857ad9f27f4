"""Training: labels, features, split, boosted trees, hold-out metrics."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from holdfast.functions.forest import Forest, score
from holdfast.functions.scores import FEATURES, features
from holdfast.operators.aggregates import auc_roc, threshold_metrics
from holdfast.operators.checks import has_two_classes, require_two_classes
from holdfast.operators.labels import label_churn
from holdfast.operators.splits import split_for_training, time_split
from holdfast.plans.boosting import BoostParams, fit
from holdfast.session import materialise
from holdfast.sources.registry import save_model


@dataclass(frozen=True)
class TrainParams(BoostParams):
    """Settings of the boosted trees and of the slices they are fitted, stopped and tested on."""

    train_share: float = 0.8
    unstopped: int = 100


@dataclass(frozen=True)
class TrainResult:
    model: Forest
    metrics: dict[str, float]
    params: dict[str, object]
    example: DataFrame


def training_rows(
    snapshot: DataFrame, history: DataFrame, horizon: int = 7, deduplicate: bool = True
) -> DataFrame:
    """Labelled feature rows, written down once: training reads them many times."""
    labelled = features(label_churn(snapshot, history, horizon, deduplicate))
    return materialise(labelled.select("user_id", "event_date", *FEATURES, "label"))


def fit_and_stop(rows: DataFrame, params: TrainParams) -> tuple[Forest, list[float]]:
    """Fit on the earlier rows, stop by the area on the latest ones.

    Where one of the slices lacks a class, nothing can stop the fit: all rows get
    ``unstopped`` rounds.
    """
    parts = time_split(rows, params.train_share)
    early, late = parts.filter("is_train"), parts.filter("not is_train")
    if has_two_classes(early) and has_two_classes(late):
        return fit(early, late, FEATURES, params)
    return fit(rows, None, FEATURES, replace(params, rounds=min(params.rounds, params.unstopped)))


def evaluate(scored: DataFrame, threshold: float = 0.5) -> dict[str, float]:
    """Area under the ROC curve, recall and precision of scored, labelled rows."""
    at = threshold_metrics(scored, threshold).first()
    return {
        "auc_roc": auc_roc(scored),
        f"recall_{threshold}": at["recall"],
        f"precision_{threshold}": at["precision"],
    }


def train(rows: DataFrame, params: TrainParams = TrainParams()) -> TrainResult:
    """Split by time, fit until the latest training rows stop it, and measure on the test rows.

    ``rows`` should be stored (see :func:`training_rows`).
    """
    require_two_classes(rows)
    parts = split_for_training(rows, params.train_share)
    train_rows = parts.filter("is_train").drop("is_train")
    test_rows = parts.filter("not is_train").drop("is_train")
    model, areas = fit_and_stop(train_rows, params)
    metrics = evaluate(materialise(score(test_rows, model).select("churn_probability", "label")))
    used = {**params.__dict__, "rounds": model.rounds, "fitted_rounds": len(areas) or model.rounds}
    return TrainResult(model, metrics, used, train_rows.select(*FEATURES))


def train_and_register(
    snapshot: DataFrame, history: DataFrame, root: str, params: TrainParams = TrainParams()
) -> int:
    """Train on all labelled snapshots and make the model the latest of ``root``."""
    result = train(training_rows(snapshot, history), params)
    return save_model(result.model, root, result.metrics, result.params, result.example)
