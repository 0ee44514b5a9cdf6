"""Columns from data values without a column each: dictionaries and sparse rows.

A dictionary is a table that gives every value of one or several columns a dense position, so it may
have any number of entries. A sparse row keeps the positions it has, in ascending order, and what it
holds there; everything else is 0.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.config import missing_columns
from returnscope.operators.cleaning import number_ranges
from returnscope.operators.ranking import running_total
from returnscope.operators.skew import spread_join
from returnscope.sources.tables import load_text, save_text


def dictionary(df: DataFrame, names: Sequence[str], first: int = 0) -> DataFrame:
    """Distinct non-null ``names`` with ``position``, counted up from ``first`` in their order.

    Values are counted into one before they are ordered, and the order is cut into ranges, so neither
    a common value nor a long dictionary lands in one task.
    """
    known = df.select(*names).dropna().distinct().withColumn("_one", F.lit(1).cast("long"))
    placed = running_total(known, [F.col(n) for n in names], "_one", "position")
    return placed.select(*names, (F.col("position") + first).alias("position"))


def gathered(
    df: DataFrame, known: DataFrame, names: Sequence[str], ids: Sequence[str], measures: Sequence[str], positions: str
) -> DataFrame:
    """One sparse row per ``ids``: ``positions`` and, beside them, an array per measure.

    ``df`` has a row per (ids, names). Names that ``known`` lacks have no entry, and neither have
    entries whose measures are all null. The join is spread, since some names are in most rows.
    """
    placed = spread_join(df.select(*ids, *names, *measures), known, names, "left", list(ids))
    held = F.coalesce(*measures).isNotNull() if len(measures) > 1 else F.col(measures[0]).isNotNull()
    entry = F.when(F.col("position").isNotNull() & held, F.struct("position", *measures))
    entries = F.array_sort(F.collect_list(entry))
    rows = placed.groupBy(*ids).agg(entries.alias("_entries"))
    columns = [F.col("_entries")[c].alias(name) for c, name in [("position", positions), *zip(measures, measures)]]
    return rows.select(*ids, *columns)


def unfolded(rows: DataFrame, known: DataFrame, ids: Sequence[str], positions: str, measures: Sequence[str]) -> DataFrame:
    """A row per (ids, names) that a sparse row has an entry for: the way back from :func:`gathered`."""
    entries = rows.select(*ids, F.explode(F.arrays_zip(F.col(positions).alias("position"), *measures)).alias("e"))
    flat = entries.select(*ids, "e.position", *[F.col(f"e.{m}").alias(m) for m in measures])
    return spread_join(flat, known, ["position"], "inner", list(ids)).drop("position")


@dataclass(frozen=True)
class SparseEncoder:
    """One-hot levels and scaled numbers as sparse rows, for any number of levels.

    Numbers have the positions before ``len(ranges)``, levels those after. ``levels`` is a table
    (column, level, position), so neither fitting nor encoding brings levels to the driver.
    """

    categorical: list[str]
    ranges: dict[str, tuple[float | None, float | None]]
    levels: DataFrame
    size: int

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SparseEncoder:
        """One job for the ranges, and one for the levels of all columns together."""
        if not numeric and not categorical:
            raise ValueError("at least one numeric or categorical feature is required")
        ranges = {}
        if numeric:
            ranges = number_ranges(train, numeric)
        levels = dictionary(cls._stacked(train, [], categorical), ["column", "level"], len(ranges))
        return cls(list(categorical), ranges, levels, len(ranges) + levels.count())

    @staticmethod
    def _stacked(df: DataFrame, ids: Sequence[str], categorical: Sequence[str]) -> DataFrame:
        """A row per (ids, categorical column) that has a level."""
        none = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("level"))
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in categorical]
        return df.select(*ids, F.inline(F.array(*pairs) if pairs else F.array(none))).filter(F.col("level").isNotNull())

    def _number(self, name: str) -> Column:
        """Training range to [0, 1]; unseen values may lie outside, a constant column gives 0."""
        low, high = self.ranges[name]
        if low is None or high is None:
            return F.lit(0.0)
        return F.coalesce((F.col(name) - F.lit(low)) / F.lit(high - low if high > low else 1.0), F.lit(0.0))

    def transform(self, df: DataFrame, ids: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
        """``ids``, ``keep``, and ``positions`` with their ``values``; zeros and levels that training didn't see have none.

        ``ids`` name a row.
        """
        lacking = missing_columns(df.columns, [*self.categorical, *self.ranges])
        if lacking:
            raise ValueError(f"columns known from training are missing: {lacking}")
        stacked = self._stacked(df, ids, self.categorical).withColumn("value", F.lit(1.0))
        marks = gathered(stacked, self.levels, ["column", "level"], ids, ["value"], "_marked").withColumnRenamed("value", "_ones")
        scaled = F.filter(
            F.array(*[F.struct(F.lit(n).cast("long").alias("position"), self._number(c).cast("double").alias("value")) for n, c in enumerate(self.ranges)])
            if self.ranges
            else F.lit(None).cast("array<struct<position:bigint,value:double>>"),
            lambda e: e["value"] != 0,
        )
        numbers = df.select(*ids, *keep, F.coalesce(scaled, F.array().cast("array<struct<position:bigint,value:double>>")).alias("_numbers"))
        whole = numbers.join(marks, list(ids), "left")
        nothing = F.array().cast("array<bigint>")
        return whole.select(
            *ids,
            *keep,
            F.concat(F.col("_numbers.position"), F.coalesce("_marked", nothing)).alias("positions"),
            F.concat(F.col("_numbers.value"), F.coalesce("_ones", F.array().cast("array<double>"))).alias("values"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        state = {"categorical": self.categorical, "ranges": self.ranges, "size": self.size}
        save_text(spark, json.dumps(state), f"{path}/state")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SparseEncoder:
        state = json.loads(load_text(spark, f"{path}/state"))
        ranges = {c: tuple(r) for c, r in state["ranges"].items()}
        return cls(state["categorical"], ranges, spark.read.parquet(f"{path}/levels"), state["size"])


def as_vectors(rows: DataFrame, size: int, name: str = "features") -> DataFrame:
    """Sparse rows as vectors, for estimators that ask for them."""

    @F.udf(VectorUDT())
    def vector(positions: list[int], values: list[float]) -> SparseVector:
        return SparseVector(size, positions, values)

    return rows.withColumn(name, vector("positions", "values")).drop("positions", "values")
