"""Run parameters, enumerations and names shared by every job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from enum import Enum

TRANSACTION_KEYS = ["transaction_id", "transaction_date"]
SPLIT_COLUMN = "train_test"

# Fixed values.
SMOOTHING_WEIGHT = 0.2
IMBALANCE_RATIO = 5.0
ROLLING_WINDOWS = (3, 7, 30)
MAX_COLUMN_NAME = 128

# Upper bound for anything that turns data values into columns (event names, one-hot levels).
MAX_VOCABULARY = 2_000


class PipelineMode(Enum):
    TRAINING = "TRAINING"
    PREDICTION = "PREDICTION"


class LabelType(Enum):
    NUMERICAL = "numerical"
    CATEGORICAL = "categorical"


class Split(Enum):
    TRAIN = "train"
    TEST = "test"


class Target(Enum):
    VALUE = "refund_value"
    FLAG = "refund_flag"
    PROPORTION = "refund_proportion"


class CustomerType(Enum):
    FIRST = "first time purchase"
    EXISTING = "existing customer transaction"


class ModelFamily(Enum):
    LINEAR_REGRESSION = "linear_reg"
    LOGISTIC_REGRESSION = "logistic_reg"
    BOOSTED_TREE_REGRESSOR = "boosted_tree_regressor"
    BOOSTED_TREE_CLASSIFIER = "boosted_tree_classifier"
    NEURAL_CLASSIFIER = "neural_classifier"

    @property
    def is_classifier(self) -> bool:
        return self in {
            ModelFamily.LOGISTIC_REGRESSION,
            ModelFamily.BOOSTED_TREE_CLASSIFIER,
            ModelFamily.NEURAL_CLASSIFIER,
        }


@dataclass(frozen=True)
class RunWindow:
    """Date bounds of one run.

    ``start`` bounds sessions, ``transaction_start`` bounds the transactions that get a feature
    row, and ``end`` bounds everything. History before ``start`` still counts as history.
    """

    start: dt.date
    transaction_start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError("start must not be after end; reduce the return window or raise the data recency")
        if self.transaction_start > self.end:
            raise ValueError("transaction_start must not be after end; raise the transaction recency")

    @classmethod
    def for_run(
        cls,
        as_of: dt.date,
        mode: PipelineMode,
        data_recency_days: int = 365,
        return_window_days: int = 30,
        prediction_recency_days: int = 2,
    ) -> RunWindow:
        """Bounds relative to an injected run date, so that a rerun gives the same rows."""
        start = as_of - dt.timedelta(days=data_recency_days)
        if mode is PipelineMode.TRAINING:
            # Transactions still inside their return window have no settled label yet.
            return cls(start, start, as_of - dt.timedelta(days=return_window_days + 1))
        return cls(start, as_of - dt.timedelta(days=prediction_recency_days), as_of)


@dataclass(frozen=True)
class Labels:
    """Target columns by type; every list must be free of duplicates and overlap."""

    numeric: tuple[str, ...] = (Target.VALUE.value, Target.PROPORTION.value)
    categorical: tuple[str, ...] = (Target.FLAG.value,)

    def __post_init__(self) -> None:
        if not self.all:
            raise ValueError("at least one label is required")
        for kind, names in (("numeric", self.numeric), ("categorical", self.categorical)):
            if len(set(names)) != len(names):
                raise ValueError(f"duplicate {kind} labels: {list(names)}")
        overlap = set(self.numeric) & set(self.categorical)
        if overlap:
            raise ValueError(f"labels given as both numeric and categorical: {sorted(overlap)}")

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def type_of(self, label: str) -> LabelType:
        return LabelType.NUMERICAL if label in self.numeric else LabelType.CATEGORICAL


def artifact_name(mode: PipelineMode, table: str, label: str, kind: str, family: ModelFamily | None = None) -> str:
    """Name of a model, score or metrics table; writers and readers both go through here."""
    parts = [mode.value.lower(), table, label]
    if family is not None:
        parts.append(family.value)
    return "_".join([*parts, kind])


def missing_columns(columns: Sequence[str], required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in columns]
