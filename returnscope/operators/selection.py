"""Per-label feature selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import LabelType, Labels, missing_columns
from returnscope.operators.cleaning import feature_columns, melted_numbers, named_places
from returnscope.operators.ranking import value_ranks
from returnscope.sources.tables import side_by_side

MIN_CORRELATION = 0.1
MAX_P_VALUE = 0.05


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; NULL when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    )


def correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, correlation) with a numeric label, all features in one aggregation.

    Values are melted and summed by feature: an aggregation with a column per feature is too wide to be compiled.
    """
    melted = melted_numbers(df, features, F.col(label).cast("double").alias("_label"))
    found = melted.groupBy("place").agg(pearson(F.col("value"), F.col("_label")).alias("correlation"))
    return named_places(found, features, "feature")


def rank_test(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, h, p_value): do the feature's ranks differ between the label's classes 0 and 1?

    Kruskal-Wallis with tie correction. All features are melted into (feature, value) counts, and
    the mid-rank of a value follows from the running count of smaller ones; with two classes the
    p-value of the chi-square with one degree of freedom is ``erfc(sqrt(h / 2))``. Features that
    are constant, or a label with one class, give NULL.
    """
    melted = melted_numbers(df, features, F.col(label).cast("int").alias("_class"))
    melted = melted.filter(F.col("value").isNotNull() & F.col("_class").isin(0, 1))
    ranks = value_ranks(melted, ["place"], "value", extra=[F.sum("_class").alias("ones")])
    mid_rank = F.col("before") + (F.col("ties") + 1) / F.lit(2.0)
    ties = F.col("ties").cast("double")
    sums = (
        ranks.groupBy("place")
        .agg(
            F.max("total").cast("double").alias("n"),
            F.sum("ones").cast("double").alias("n1"),
            F.sum(F.col("ones") * mid_rank).alias("r1"),
            F.sum((F.col("ties") - F.col("ones")) * mid_rank).alias("r0"),
            F.sum(ties * ties * ties - ties).alias("tied"),
        )
    )
    n, n1 = F.col("n"), F.col("n1")
    spread = F.try_divide(F.col("r0") * F.col("r0"), n - n1) + F.try_divide(F.col("r1") * F.col("r1"), n1)
    raw = F.lit(12.0) / (n * (n + 1)) * spread - F.lit(3.0) * (n + 1)
    corrected = F.try_divide(raw, F.lit(1.0) - F.try_divide(F.col("tied"), n * n * n - n))
    of_place = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("place") + 1)
    return sums.select(of_place.alias("feature"), corrected.alias("h")).withColumn("p_value", _erfc(F.sqrt(F.when(F.col("h") < 0, 0.0).otherwise(F.col("h")) / 2)))


# Chebyshev coefficients of the complementary error function, relative error below 1.2e-7.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _erfc(x: Column) -> Column:
    """Complementary error function of a number that isn't negative."""
    t = F.lit(1.0) / (F.lit(1.0) + x / 2)
    series = F.lit(0.0)
    for coefficient in reversed(ERFC):
        series = series * t + F.lit(coefficient)
    return t * F.exp(series - x * x)


def correlated_features(df: DataFrame, features: Sequence[str], label: str, minimum: float = MIN_CORRELATION) -> list[str]:
    """Numeric features whose absolute correlation reaches the minimum, in their given order."""
    if not features:
        return []
    kept = {r[0] for r in correlations(df, features, label).filter(F.abs("correlation") >= minimum).select("feature").collect()}
    return [f for f in features if f in kept]


def discriminating_features(df: DataFrame, features: Sequence[str], label: str, maximum: float = MAX_P_VALUE) -> list[str]:
    """Numeric features whose rank test is significant for a binary label, in their given order."""
    if not features:
        return []
    kept = {r[0] for r in rank_test(df, features, label).filter(F.col("p_value") <= maximum).select("feature").collect()}
    return [f for f in features if f in kept]


@dataclass(frozen=True)
class FeatureSelector:
    """Columns to keep per label: chosen numeric features, the label, the ids and all strings."""

    columns: Mapping[str, list[str]]

    @classmethod
    def fit(cls, df: DataFrame, ids: Sequence[str], labels: Labels, minimum: float = MIN_CORRELATION) -> FeatureSelector:
        numbers, strings = feature_columns(df, ids, labels.all)

        def picked(label: str) -> list[str]:
            if labels.type_of(label) is LabelType.NUMERICAL:
                return correlated_features(df, numbers, label, minimum)
            return discriminating_features(df, numbers, label)

        found = side_by_side([lambda label=label: picked(label) for label in labels.all])
        return cls({label: [*some, label, *ids, *strings] for label, some in zip(labels.all, found, strict=True)})

    def transform(self, df: DataFrame) -> dict[str, DataFrame]:
        selected = {}
        for label, columns in self.columns.items():
            lacking = missing_columns(df.columns, columns)
            if lacking:
                raise ValueError(f"columns chosen for {label} are missing: {lacking}")
            selected[label] = df.select(*columns)
        return selected
