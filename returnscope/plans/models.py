"""Training and daily prediction on model-ready tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN, TRANSACTION_KEYS, ModelFamily, Split
from returnscope.operators import evaluation
from returnscope.operators.modeling import (
    SearchSpace,
    TrainedModel,
    best_trial,
    decided_class,
    feature_importance,
    positive_probability,
    score_classifier,
    score_regression,
    train,
    train_two_step,
    two_step_merge,
)
from returnscope.sources.tables import side_by_side


@dataclass(frozen=True)
class TrainingReport:
    """Models and the tables that describe them."""

    models: dict[str, TrainedModel]
    scores: DataFrame
    test_metrics: dict[str, DataFrame]
    split_metrics: DataFrame
    tiers: DataFrame
    best_trials: dict[str, DataFrame]
    importance: dict[str, DataFrame]


def train_one_step(
    table: DataFrame, label: str, family: ModelFamily = ModelFamily.LINEAR_REGRESSION, space: SearchSpace | None = None, tiers: int = 10
) -> TrainingReport:
    """A single regressor on all training rows."""
    model = train(table, label, family, space)
    scores = score_regression(model.pipeline, table, label)
    return _report({"regressor": model}, {label: table}, scores, {"regressor": _test_regression(scores)}, tiers)


def train_two_steps(
    flags: DataFrame,
    values: DataFrame,
    flag: str,
    value: str,
    classifier: ModelFamily = ModelFamily.LOGISTIC_REGRESSION,
    regressor: ModelFamily = ModelFamily.LINEAR_REGRESSION,
    space: SearchSpace | None = None,
    threshold: float = 0.5,
    gate_on_label: bool = True,
    tiers: int = 10,
) -> TrainingReport:
    """Classifier and regressor, and their merged prediction."""
    first, second = train_two_step(flags, values, flag, value, classifier, regressor, space)
    regressed = score_regression(second.pipeline, values, value)
    scores = two_step_merge(_classified(first.pipeline, flags, threshold, gate_on_label), regressed, gate_on_label, threshold)
    test_flags = flags.filter(F.col(SPLIT_COLUMN) == Split.TEST.value)
    metrics = {
        "classifier": evaluation.classification_metrics(positive_probability(first.pipeline, test_flags, flag), threshold),
        "regressor": _test_regression(regressed.filter(F.col("actual") > 0)),
    }
    return _report({"classifier": first, "regressor": second}, {flag: flags, value: values}, scores, metrics, tiers)


def _classified(classifier: PipelineModel, flags: DataFrame, threshold: float, gate_on_label: bool) -> DataFrame:
    """What the merge takes from the classifier, the same in training and serving."""
    return decided_class(classifier, flags, threshold) if gate_on_label else score_classifier(classifier, flags, threshold)


def _test_regression(scores: DataFrame) -> DataFrame:
    return evaluation.regression_metrics(scores.filter(F.col(SPLIT_COLUMN) == Split.TEST.value))


def _report(models, tables, scores, metrics, tiers) -> TrainingReport:
    errors, by_tier, best, importance = side_by_side(
        [
            lambda: evaluation.split_metrics(scores),
            lambda: evaluation.tier_comparison(scores, TRANSACTION_KEYS, tiers),
            lambda: {name: best_trial(m.trials) for name, m in models.items()},
            lambda: {name: evaluation.top_features(feature_importance(m, tables[m.label])) for name, m in models.items()},
        ],
    )
    return TrainingReport(models, scores, metrics, errors, by_tier, best, importance)


def predict_one_step(model: PipelineModel, table: DataFrame) -> DataFrame:
    return score_regression(model, table)


def predict_two_steps(
    classifier: PipelineModel, regressor: PipelineModel, flags: DataFrame, values: DataFrame, threshold: float = 0.5, gate_on_label: bool = True
) -> DataFrame:
    """Expected refund per transaction for new data.

    With the label gate the class is the more probable one at ``threshold``; with the probability
    gate the threshold is also the cut-off of the class rows.
    """
    classified = _classified(classifier, flags, threshold, gate_on_label)
    return two_step_merge(classified, score_regression(regressor, values), gate_on_label, threshold)
