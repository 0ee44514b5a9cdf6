"""Whole runs: from flat event frames to stored models, results and predictions.

A run reads the export once, cuts the feature rows into the two customer segments, and for each of them
prepares, trains or predicts, and stores what came of it under names that :func:`result_name` gives. What
it stages on the way is deleted at its end. A segment that cannot be trained, for want of rows or of a
second class, is skipped and the run log says why; prediction then leaves its customers out.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.config import TRANSACTION_KEYS, Labels, ModelFamily, PipelineMode, RunWindow, Target, artifact_name
from returnscope.operators.assemble import existing_customers, first_time_purchases
from returnscope.operators.modeling import SearchSpace, load_model, save_model
from returnscope.plans.features import build_features, stage_frames
from returnscope.plans.models import TrainingReport, predict_two_steps, train_two_steps
from returnscope.plans.preprocess import FittedPreprocessing, prepare_prediction, prepare_training
from returnscope.sources.export import EventFrames
from returnscope.sources.tables import drop_tables, path_exists, side_by_side, stage, staging, table_exists, write_table

SEGMENTS = {"existing": existing_customers, "first_purchase": first_time_purchases}
FLAG, VALUE = Target.FLAG.value, Target.VALUE.value
LOG_SCHEMA = "segment string, status string, message string, training_rows long"


@dataclass(frozen=True)
class Place:
    """Where a training run keeps its models, and the first part of its tables' names."""

    folder: str
    name: str

    def part(self, segment: str, what: str) -> str:
        return f"{self.folder}/{segment}/{what}"


def result_name(place: Place, mode: PipelineMode, segment: str, label: str, kind: str, family: ModelFamily | None = None) -> str:
    """Name of a stored table; writers and readers both go through here."""
    return f"{place.name}_{artifact_name(mode, segment, label, kind, family)}"


def read_result(spark: SparkSession, place: Place, segment: str, label: str, kind: str, family: ModelFamily | None = None) -> DataFrame:
    """Stored metrics, tiers, importance, trials or model-ready rows of a training run."""
    name = result_name(place, PipelineMode.TRAINING, segment, label, kind, family)
    if not table_exists(spark, name):
        raise ValueError(f"the training run {place.name} has stored no {kind} of {label} for {segment}")
    return spark.table(name)


def training_run(
    frames: EventFrames,
    window: RunWindow,
    place: Place,
    labels: Labels = Labels(),  # noqa: B008
    classifier: ModelFamily = ModelFamily.LOGISTIC_REGRESSION,
    regressor: ModelFamily = ModelFamily.LINEAR_REGRESSION,
    space: SearchSpace | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Train both segments and store all results; returns the run log, a row per segment."""
    spark = frames.events.sparkSession
    with staging(spark):
        run = build_features(stage_frames(frames), window)
        rows = stage(run.rows, "feature_rows")

        def trained(segment: str) -> tuple:
            try:
                data = prepare_training(SEGMENTS[segment](rows), TRANSACTION_KEYS, labels, vocabulary=run.vocabulary, keep=stage)
                stored = [lambda label=label, table=table: _stored(table, result_name(place, PipelineMode.TRAINING, segment, label, "ml_ready")) for label, table in data.tables.items()]
                tables = dict(zip(data.tables, side_by_side(stored), strict=True))
                write_table(data.label_distribution, result_name(place, PipelineMode.TRAINING, segment, "labels", "distribution"))
                report = train_two_steps(tables[FLAG], tables[VALUE], FLAG, VALUE, classifier, regressor, space, threshold)
            except ValueError as reason:
                return segment, "SKIPPED", str(reason)[:500], 0
            _store(place, segment, report)
            data.fitted.save(spark, place.part(segment, "preprocessing"))
            return segment, "TRAINED", None, tables[VALUE].filter("train_test = 'train'").count()

        log = side_by_side([lambda segment=segment: trained(segment) for segment in SEGMENTS])
    done = spark.createDataFrame(log, LOG_SCHEMA)
    write_table(done, f"{place.name}_training_log")
    return training_log(spark, place)


def training_log(spark: SparkSession, place: Place) -> DataFrame:
    """What became of each segment."""
    return spark.table(f"{place.name}_training_log")


def trained_segments(spark: SparkSession, place: Place) -> list[str]:
    return [s for s in SEGMENTS if path_exists(spark, place.part(s, "preprocessing"))]


def _stored(df: DataFrame, name: str) -> DataFrame:
    write_table(df, name)
    return df.sparkSession.table(name)


def _store(place: Place, segment: str, report: TrainingReport) -> None:
    steps = []
    for role, model in report.models.items():
        save_model(model.pipeline, place.part(segment, role))
        for kind, table in (("trials", model.trials), ("importance", report.importance[role]), ("test_metrics", report.test_metrics[role])):
            steps.append((table, result_name(place, PipelineMode.TRAINING, segment, model.label, kind, model.family)))
    for kind, table in (("split_metrics", report.split_metrics), ("tiers", report.tiers)):
        steps.append((table, result_name(place, PipelineMode.TRAINING, segment, VALUE, kind)))
    side_by_side([lambda table=table, name=name: write_table(table, name) for table, name in steps])


def prediction_run(frames: EventFrames, window: RunWindow, place: Place, threshold: float = 0.5) -> DataFrame:
    """Expected refunds of the window's transactions: keys, ``segment``, ``transaction_value``, ``prediction``.

    The rows are stored under the run's name and replace the last prediction; a transaction is in the
    segment that its customer's past puts it in.
    """
    spark = frames.events.sparkSession
    trained = trained_segments(spark, place)
    if not trained:
        raise ValueError(f"the training run {place.name} has stored no model")
    name = f"{place.name}_{PipelineMode.PREDICTION.value.lower()}"
    with staging(spark):
        fitted = {s: FittedPreprocessing.load(spark, place.part(s, "preprocessing")) for s in trained}
        vocabulary = sorted({name for f in fitted.values() for name in f.vocabulary})
        rows = stage(build_features(stage_frames(frames), window, vocabulary).rows, "feature_rows")
        parts = side_by_side([lambda s=s: _predicted(spark, place, s, SEGMENTS[s](rows), fitted[s], threshold) for s in trained])
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        write_table(whole, name)
    return spark.table(name)


def _predicted(spark: SparkSession, place: Place, segment: str, rows: DataFrame, fitted: FittedPreprocessing, threshold: float) -> DataFrame:
    tables = prepare_prediction(rows, fitted)
    classifier, regressor = side_by_side([lambda role=role: load_model(place.part(segment, role)) for role in ("classifier", "regressor")])
    predicted = predict_two_steps(classifier, regressor, tables[FLAG], tables[VALUE], threshold)
    value = rows.select(*TRANSACTION_KEYS, "transaction_value")
    # Cleaning casts the keys, and so do the value's.
    keyed = value.select(*[F.col(k).cast(predicted.schema[k].dataType).alias(k) for k in TRANSACTION_KEYS], "transaction_value")
    return predicted.join(keyed, TRANSACTION_KEYS, "left").select(*TRANSACTION_KEYS, F.lit(segment).alias("segment"), "transaction_value", "prediction")


def forget(spark: SparkSession, place: Place, kinds: Mapping[str, list[str]] | None = None) -> list[str]:
    """Drop the run's tables, or those of the given kinds by label; returns what was dropped."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{place.name}_")]
    if kinds is not None:
        names = [n for n in names if any(f"_{label}_" in n and n.endswith(kind) for label, some in kinds.items() for kind in some)]
    return drop_tables(spark, names)
