"""One-hot encoding and min-max scaling with a fitted, storable state."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import MAX_VOCABULARY, missing_columns
from returnscope.operators.cleaning import number_ranges
from returnscope.sources.columns import clean_name, refuse_clashes
from returnscope.sources.tables import bounded_levels


@dataclass(frozen=True)
class Encoder:
    """Levels of the string features and ranges of the numeric ones, as seen in training."""

    levels: dict[str, list[str]]
    ranges: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], limit: int = MAX_VOCABULARY) -> Encoder:
        """One job for all ranges and one for all levels, which become columns, hence their checked number.

        :class:`returnscope.operators.sparse.SparseEncoder` takes any number of levels.
        """
        if not numeric and not categorical:
            raise ValueError("at least one numeric or categorical feature is required")
        levels = bounded_levels(train, categorical, limit)
        ranges = {}
        if numeric:
            ranges = number_ranges(train, numeric)
        refuse_clashes([clean_name(f"cat_{c}_{v}") for c in levels for v in levels[c]] + [clean_name(f"num_{c}") for c in ranges])
        return cls(levels, ranges)

    def only(self, columns: Sequence[str]) -> Encoder:
        """The part that encodes ``columns``."""
        kept = set(columns)
        return Encoder({c: v for c, v in self.levels.items() if c in kept}, {c: r for c, r in self.ranges.items() if c in kept})

    def _scaled(self, name: str) -> Column:
        """Training range to [0, 1]; unseen values may lie outside, a constant column gives 0."""
        low, high = self.ranges[name]
        if low is None or high is None:
            return F.lit(0.0)
        width = high - low if high > low else 1.0
        return (F.col(name) - F.lit(low)) / F.lit(width)

    def encoded(self) -> list[Column]:
        """Level columns, all zero for a level that training did not see, then the scaled ones."""
        marks = [
            (F.col(c).eqNullSafe(F.lit(v))).cast("double").alias(clean_name(f"cat_{c}_{v}"))
            for c, values in self.levels.items()
            for v in values
        ]
        return [*marks, *[self._scaled(c).alias(clean_name(f"num_{c}")) for c in self.ranges]]

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` (ids, label, split) and the encoded features."""
        lacking = missing_columns(df.columns, [*self.levels, *self.ranges])
        if lacking:
            raise ValueError(f"columns known from training are missing: {lacking}")
        columns = self.encoded()
        return df.select(*[c for c in keep if c in df.columns], *columns)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Encoder:
        state = json.loads(text)
        return cls(state["levels"], {c: tuple(r) for c, r in state["ranges"].items()})
