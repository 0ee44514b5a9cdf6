"""Type coercion, imputation, validity shares and removal of useless rows and columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returnscope.config import Labels
from returnscope.functions.strings import UNKNOWN
from returnscope.operators.selecting import order_statistics
from returnscope.sources.tables import stage

# Text that carries no information.
INVALID_STRINGS = ["unknown", "Unassigned", "unassigned"]


@dataclass(frozen=True)
class ColumnKinds:
    dates: list[str]
    strings: list[str]
    numbers: list[str]


def column_kinds(df: DataFrame) -> ColumnKinds:
    """Columns by type: dates and timestamps, numbers, and everything else as strings."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    strings = [c for c in df.columns if c not in dates and c not in numbers]
    return ColumnKinds(dates, strings, numbers)


def feature_columns(df: DataFrame, ids: Sequence[str], labels: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, string) features: all columns but ids, labels and dates."""
    kinds = column_kinds(df)
    taken = {*ids, *labels}
    return [c for c in kinds.numbers if c not in taken], [c for c in kinds.strings if c not in taken]


def coerce_types(df: DataFrame, kinds: ColumnKinds | None = None) -> DataFrame:
    """Strings, doubles and dates; text that is not a ``yyyy-MM-dd`` date becomes NULL."""
    kinds = kinds or column_kinds(df)
    types = dict(df.dtypes)

    def coerced(name: str) -> Column:
        column = F.col(name)
        if name in kinds.numbers:
            return column.cast("double").alias(name)
        if name in kinds.dates:
            date = F.try_to_timestamp(column, F.lit("yyyy-MM-dd")).cast("date") if types[name] == "string" else column.cast("date")
            return date.alias(name)
        return column.cast("string").alias(name)

    return df.select(*[coerced(c) for c in df.columns])


def impute(df: DataFrame) -> DataFrame:
    """Missing numbers become 0, missing strings ``unknown``; dates stay missing."""
    kinds = column_kinds(df)
    return df.na.fill({**{c: 0 for c in kinds.numbers}, **{c: UNKNOWN for c in kinds.strings}})


def melted_numbers(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """``place`` and ``value``, a row for each of the columns, with ``keep`` beside them.

    Sums by place are one small compiled aggregate, where an aggregation with a column each for hundreds
    of columns takes seconds to plan and compile.
    """
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    return df.select(*keep, F.posexplode(values).alias("place", "value"))


def named_places(found: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``found`` with the columns' names under ``name`` in place of ``place``; columns without rows have nulls."""
    names = found.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("place", name))
    # A row per column, on both sides.
    return names.join(F.broadcast(found), "place", "left").drop("place")


def number_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest value of each column; None where it has none."""
    bounds = melted_numbers(df, columns).groupBy("place").agg(F.min("value"), F.max("value")).collect()
    found = {columns[r[0]]: (r[1], r[2]) for r in bounds}
    return {c: found.get(c, (None, None)) for c in columns}


def is_invalid_number(column: Column) -> Column:
    """Zero counts as invalid, as does a missing value."""
    return column.isNull() | (column == 0)


def is_invalid_string(column: Column) -> Column:
    return column.isNull() | column.isin(INVALID_STRINGS)


def _invalid_marks(df: DataFrame) -> dict[str, Column]:
    """0/1 per checked column; numbers first, then strings. Ids and labels are checked too."""
    kinds = column_kinds(df)
    marks = {c: is_invalid_number(F.col(c)) for c in kinds.numbers}
    marks.update({c: is_invalid_string(F.col(c)) for c in kinds.strings})
    return {c: mark.cast("int") for c, mark in marks.items()}


def row_invalid_share(df: DataFrame) -> Column:
    """Share of a row's number and string columns that are invalid.

    Summed over an array: a chain of additions nests as deep as there are columns and overflows.
    """
    marks = list(_invalid_marks(df).values())
    return F.aggregate(F.array(*marks), F.lit(0), lambda total, mark: total + mark) / F.lit(len(marks))


def column_invalid_shares(df: DataFrame) -> DataFrame:
    """(column, invalid rows, share) from a single pass over the data."""
    marks = _invalid_marks(df)
    melted = df.select(F.posexplode(F.array(*marks.values())).alias("place", "mark"))
    counted = melted.groupBy("place").agg(F.count("*").alias("_rows"), F.sum("mark").alias("invalid_count"))
    return named_places(counted, list(marks), "column_name").select(
        "column_name", "invalid_count", (F.col("invalid_count") / F.col("_rows")).alias("invalid_share")
    )


def invalid_columns(df: DataFrame, threshold: float) -> list[str]:
    """Names of columns whose invalid share is above the threshold; one row per column is read."""
    return [r[0] for r in column_invalid_shares(df).filter(F.col("invalid_share") > threshold).select("column_name").collect()]


def drop_invalid_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.filter(row_invalid_share(df) <= threshold)


def drop_invalid_columns(df: DataFrame, ids: Sequence[str], labels: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Ids and labels first, then the features that are valid often enough."""
    bad = set(invalid_columns(df, threshold))
    fixed = [*ids, *labels]
    return df.select(*fixed, *[c for c in df.columns if c not in fixed and c not in bad])


def drop_invalid_rows_and_columns(
    df: DataFrame, ids: Sequence[str], labels: Sequence[str], row_threshold: float = 0.5, column_threshold: float = 0.95
) -> DataFrame:
    """Both shares are judged on the same input, before anything is removed."""
    kept = drop_invalid_columns(df, ids, labels, column_threshold).columns
    return drop_invalid_rows(df, row_threshold).select(*kept)


def invalid_summary(df: DataFrame, row_threshold: float = 0.5, column_threshold: float = 0.95) -> DataFrame:
    """One row: sizes, and how many rows and which columns are mostly invalid."""
    marks = _invalid_marks(df)
    counted = df.agg(
        F.count("*").alias("row_count"),
        F.count_if(row_invalid_share(df) > row_threshold).alias("invalid_row_count"),
        *[F.sum(m).alias(f"m_{c}") for c, m in marks.items()],
    )
    bad = F.array_compact(
        F.array(*[F.when(F.col(f"`m_{c}`") / F.col("row_count") > column_threshold, F.lit(c)) for c in marks])
    )
    return counted.select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        "invalid_row_count",
        F.size(bad).cast("long").alias("invalid_column_count"),
        F.array_join(bad, ", ").alias("invalid_columns"),
    )


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with exactly one distinct non-NULL value, found by comparing minimum and maximum.

    This avoids counting distinct values of every column, which would multiply the data.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    others = [c for c in df.columns if c not in doubles]
    same = F.min("value") == F.max("value")
    found = melted_numbers(df, doubles).groupBy("place").agg(same.alias("same")).filter("same").collect() if doubles else []
    constant = {doubles[r["place"]] for r in found}
    if others:
        bounds = df.agg(F.struct(*[(F.min(c) == F.max(c)).alias(c) for c in others]).alias("same")).first()["same"]
        constant |= {c for c in others if bounds[c]}
    return [c for c in df.columns if c in constant]


def drop_constant_columns(df: DataFrame, ids: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Drop constant features; a constant label is an error, a constant id is kept."""
    constant = constant_columns(df)
    useless = [c for c in labels if c in constant]
    if useless:
        raise ValueError(f"labels with a single value cannot be learned: {useless}")
    return df.drop(*[c for c in constant if c not in {*ids, *labels}])


QUANTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum, one row per statistic.

    Quartiles interpolate linearly between neighbouring values, which counting passes find for all
    columns together; a column without values has a count of 0 and nulls. The columns are written once,
    since every pass reads them.
    """
    spark = df.sparkSession
    numbers = stage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "described")
    row = numbers.agg(
        *[F.struct(F.count(c), F.avg(c), F.stddev_samp(c), F.min(c), F.max(c)).alias(c) for c in columns]
    ).first()
    position = {(c, q): share * (row[c][0] - 1) for c in columns for q, share in QUANTILES.items() if row[c][0]}
    wanted = {c: sorted({e for q in QUANTILES for e in (math.floor(position[c, q]), math.ceil(position[c, q]))}) for c in columns if row[c][0]}
    found = order_statistics(numbers, wanted, {c: (row[c][3], row[c][4]) for c in wanted})
    table: dict[str, list[float | None]] = {}
    for c in columns:
        n, mean, std, low, high = row[c]
        quartiles: list[float | None] = []
        for q in QUANTILES:
            if not n:
                quartiles.append(None)
                continue
            at = position[c, q]
            below, above = found[c, math.floor(at)], found[c, math.ceil(at)]
            quartiles.append(below + (above - below) * (at - math.floor(at)))
        table[c] = [float(n), mean, std, low, *quartiles, high]
    names = ["count", "mean", "std", "min", *QUANTILES, "max"]
    schema = T.StructType([T.StructField("statistic", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in columns]])
    return spark.createDataFrame([(name, *[table[c][i] for c in columns]) for i, name in enumerate(names)], schema)


def clean(
    df: DataFrame,
    ids: Sequence[str],
    labels: Labels,
    training: bool,
    row_threshold: float = 0.5,
    column_threshold: float = 0.95,
) -> DataFrame:
    """Coerce and impute; only training also removes mostly invalid rows and columns."""
    cleaned = impute(coerce_types(df))
    if not training:
        return cleaned
    return drop_invalid_rows_and_columns(cleaned, ids, labels.all, row_threshold, column_threshold)
