"""Balancing the two classes of a label."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import IMBALANCE_RATIO, LabelType
from returnscope.operators.ranking import hash_position


class Strategy(Enum):
    NONE = "none"
    OVER = "oversample"
    UNDER = "undersample"


def label_class(label: str, kind: LabelType) -> Column:
    """Numeric labels fall into the classes "above zero" and "not"; others are classes as they stand, text included."""
    value = F.col(label)
    return F.when(value > 0, 1).otherwise(0) if kind is LabelType.NUMERICAL else value


def class_counts(df: DataFrame, label: str, kind: LabelType) -> DataFrame:
    return df.groupBy(label_class(label, kind).alias("label_class")).agg(F.count("*").alias("row_count"))


def choose(counts: dict[object, int], wanted: Strategy) -> Strategy:
    """The wanted strategy, or none if the classes are balanced enough or there is a single one."""
    balanced = len(counts) < 2 or max(counts.values()) / min(counts.values()) <= IMBALANCE_RATIO
    return Strategy.NONE if balanced else wanted


@dataclass(frozen=True)
class Extremes:
    """The smallest and the largest class, and how many classes there are."""

    classes: int
    few: object
    few_rows: int
    many: object
    many_rows: int


def extremes(df: DataFrame, label: str, kind: LabelType) -> Extremes:
    """Found in Spark, so that any number of classes gives one row. Rows without a class belong to none."""
    counts = class_counts(df, label, kind).filter(F.col("label_class").isNotNull())
    pair = F.struct("row_count", "label_class")
    row = counts.agg(F.count("*").alias("n"), F.min(pair).alias("few"), F.max(pair).alias("many")).first()
    if not row["n"]:
        return Extremes(0, None, 0, None, 0)
    return Extremes(row["n"], row["few"][1], row["few"][0], row["many"][1], row["many"][0])


def resample(
    df: DataFrame, label: str, kind: LabelType, ids: Sequence[str], strategy: Strategy, seed: int = 0, always: bool = True
) -> DataFrame:
    """Bring the classes to the same size, exactly and reproducibly; unless ``always``, only unbalanced ones.

    Which rows are dropped or repeated follows from a seeded hash of their ids. Undersampling keeps
    as many majority rows as there are minority rows; oversampling repeats every minority row
    equally often and gives the remainder one copy more.
    """
    if strategy is Strategy.NONE:
        return df
    found = extremes(df, label, kind)
    strategy = strategy if always else choose({found.few: found.few_rows, found.many: found.many_rows}, strategy)
    if strategy is Strategy.NONE or found.classes < 2:
        return df
    few, many = F.lit(found.few), F.lit(found.many)
    row_class = label_class(label, kind)
    if strategy is Strategy.UNDER:
        majority = hash_position(df.filter(row_class == many), ids, "_position", seed)
        return df.filter(~row_class.eqNullSafe(many)).unionByName(majority.filter(F.col("_position") <= found.few_rows).drop("_position"))
    copies, extra = divmod(found.many_rows, found.few_rows)
    minority = hash_position(df.filter(row_class == few), ids, "_position", seed)
    repeated = minority.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.lit(copies) + F.when(F.col("_position") <= extra, 1).otherwise(0)))
    )
    return df.filter(~row_class.eqNullSafe(few)).unionByName(repeated.drop("_copy", "_position"))
