"""Train and test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN, Split
from returnscope.functions.hashing import row_hash, row_uniform
from returnscope.operators.ranking import running_total


def number_of_test_rows(rows: int, share: float, fixed: int | None = None) -> int:
    """The share at every size, or a fixed number if asked for; never none and never all."""
    wanted = int(share * rows) if fixed is None else fixed
    return max(1, min(wanted, rows - 1))


def split_ordered(df: DataFrame, order_by: Sequence[str], ids: Sequence[str], share: float = 0.1, latest: bool = True, test_rows: int | None = None) -> DataFrame:
    """The last rows in the given order are the test set: the latest ones, or the earliest.

    Ids break ties, so they must identify a row. The boundary row is found over range partitions of
    the positions alone; every row is then tagged by comparing with it. ``test_rows`` sets a number
    instead of the share.
    """
    rows = df.count()
    if rows < 2:
        raise ValueError("a split needs at least two rows")
    position = F.struct(*[F.col(c) for c in dict.fromkeys([*order_by, *ids])])
    order = F.col("position").desc() if latest else F.col("position").asc()
    placed = running_total(df.select(position.alias("position"), F.lit(1).alias("one")), [order], "one", "before")
    last = placed.filter(F.col("before") == number_of_test_rows(rows, share, test_rows) - 1)
    boundary = last.agg(F.min("position").alias("position")).scalar()
    is_test = position >= boundary if latest else position <= boundary
    return df.withColumn(SPLIT_COLUMN, _tag(is_test))


def split_hash(df: DataFrame, ids: Sequence[str], share: float = 0.1, seed: int = 0) -> DataFrame:
    """Stateless split on a hash of the id: a transaction stays on its side in every run."""
    return df.withColumn(SPLIT_COLUMN, _tag(F.pmod(row_hash(ids, seed), F.lit(100)) < F.lit(share * 100)))


def split_random(df: DataFrame, ids: Sequence[str], train_share: float = 0.8, seed: int = 0) -> DataFrame:
    """Random split where the draw is rounded to one decimal and compared with the train share."""
    return df.withColumn(SPLIT_COLUMN, _tag(F.round(row_uniform(ids, seed), 1) > F.lit(train_share)))


def _tag(is_test: Column) -> Column:
    return F.when(is_test, Split.TEST.value).otherwise(Split.TRAIN.value)


def tables_by_label(df: DataFrame, labels: Sequence[str], ids: Sequence[str], share: float = 0.1, seed: int = 0) -> dict[str, DataFrame]:
    """For a table the user prepared: one table per label, without the other labels, split by hash."""
    tagged = split_hash(df, ids, share, seed)
    rest = [c for c in df.columns if c not in labels]
    return {label: tagged.select(*rest, label, SPLIT_COLUMN) for label in labels}
