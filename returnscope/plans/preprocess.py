"""From feature rows to one model-ready table per label."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN, Labels, Split
from returnscope.operators.cleaning import clean, describe, drop_constant_columns, feature_columns
from returnscope.operators.encoding import Encoder
from returnscope.operators.resampling import Strategy, resample
from returnscope.operators.selection import MIN_CORRELATION, FeatureSelector
from returnscope.operators.splitting import split_ordered
from returnscope.sources.columns import clean_column_names
from returnscope.sources.tables import load_text, no_stage, save_text, side_by_side


@dataclass(frozen=True)
class FittedPreprocessing:
    """What prediction needs from training: chosen columns and encoders per label, event names."""

    ids: list[str]
    labels: Labels
    selector: FeatureSelector
    encoders: dict[str, Encoder]
    vocabulary: list[str]

    def save(self, spark: SparkSession, path: str) -> None:
        state = {
            "ids": self.ids,
            "numeric_labels": list(self.labels.numeric),
            "categorical_labels": list(self.labels.categorical),
            "columns": dict(self.selector.columns),
            "encoders": {label: encoder.to_json() for label, encoder in self.encoders.items()},
            "vocabulary": self.vocabulary,
        }
        save_text(spark, json.dumps(state), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedPreprocessing:
        state = json.loads(load_text(spark, path))
        return cls(
            state["ids"],
            Labels(tuple(state["numeric_labels"]), tuple(state["categorical_labels"])),
            FeatureSelector(state["columns"]),
            {label: Encoder.from_json(text) for label, text in state["encoders"].items()},
            state["vocabulary"],
        )


@dataclass(frozen=True)
class TrainingData:
    tables: dict[str, DataFrame]
    label_distribution: DataFrame
    fitted: FittedPreprocessing


def prepare_training(
    df: DataFrame,
    ids: Sequence[str],
    labels: Labels,
    order_by: Sequence[str] = ("transaction_date",),
    latest_as_test: bool = True,
    test_share: float = 0.1,
    row_threshold: float = 0.5,
    column_threshold: float = 0.95,
    min_correlation: float = MIN_CORRELATION,
    balance: Strategy = Strategy.NONE,
    vocabulary: Sequence[str] = (),
    keep=no_stage,
) -> TrainingData:
    """Clean, drop constants, select, split, encode and scale.

    Features are selected on all rows, before the split. Encoders are fitted on training rows
    only. ``balance`` says how to resample the training rows of a label with unbalanced classes; ``keep`` may write the cleaned
    rows, which every later step reads.
    """
    if not labels.numeric or not labels.categorical:
        raise ValueError("training needs at least one numeric and one categorical label")
    cleaned = keep(clean(clean_column_names(df), ids, labels, True, row_threshold, column_threshold), "cleaned")
    useful = drop_constant_columns(cleaned, ids, labels.all)
    # One split and one fit serve all labels: both depend on the rows alone.
    selector, split, described = side_by_side(
        [
            lambda: FeatureSelector.fit(useful, ids, labels, min_correlation),
            lambda: keep(split_ordered(useful, order_by, ids, test_share, latest_as_test), "split"),
            lambda: describe(cleaned, labels.all),
        ],
    )
    is_train = F.col(SPLIT_COLUMN) == Split.TRAIN.value
    chosen = {label: selector.columns[label] for label in labels.all}
    numbers, strings = feature_columns(useful, ids, labels.all)
    used = {c for columns in chosen.values() for c in columns}
    encoder = Encoder.fit(split.filter(is_train), [c for c in numbers if c in used], [c for c in strings if c in used])
    tables, encoders = {}, {}
    for label, columns in chosen.items():
        encoders[label] = encoder.only(columns)
        rows = split.select(*columns, SPLIT_COLUMN)
        if balance is not Strategy.NONE:
            kind = labels.type_of(label)
            rows = resample(rows.filter(is_train), label, kind, ids, balance, always=False).unionByName(rows.filter(~is_train))
        tables[label] = encoders[label].transform(rows, [*ids, label, SPLIT_COLUMN])
    fitted = FittedPreprocessing(list(ids), labels, selector, encoders, list(vocabulary))
    return TrainingData(tables, described, fitted)


def prepare_prediction(df: DataFrame, fitted: FittedPreprocessing) -> dict[str, DataFrame]:
    """The same columns for new rows: no row or column is dropped, nothing is fitted."""
    cleaned = clean(clean_column_names(df), fitted.ids, fitted.labels, training=False)
    return {
        label: fitted.encoders[label].transform(rows, [*fitted.ids, label])
        for label, rows in fitted.selector.transform(cleaned).items()
    }
