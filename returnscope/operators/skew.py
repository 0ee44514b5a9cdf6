"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy when it holds more than one of so many rows; hence there are never more heavy keys than this.
HEAVY_SHARE = 512
# Buckets in which keys are counted first; only a bucket with many rows can hold a heavy key.
COUNT_BUCKETS = 1 << 16
# A table of no more rows is joined by broadcast.
SMALL_ROWS = 200_000


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """Keys that hold more than one of ``share`` rows, and ``parts``, into how many parts to split each.

    At most ``share`` rows, and at most twice as many parts in all, whatever the data. Counts are
    summed before they are shuffled, by bucket of the keys' hash first: only keys in a bucket that holds
    as many rows are counted one by one. Keys with a null never match and aren't heavy.
    """
    complete = df.dropna(subset=list(keys))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(COUNT_BUCKETS))
    buckets = complete.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    total = buckets.agg(F.sum("_n")).first()[0] or 0
    full = [r["_bucket"] for r in buckets.filter((F.col("_n") > 1) & (F.col("_n") * share > total)).collect()]
    counts = complete.filter(bucket.isin(full)).groupBy(*keys).agg(F.count("*").alias("_n"))
    heavy = counts.filter((F.col("_n") > 1) & (F.col("_n") * share > total))
    return heavy.select(*keys, (F.floor(F.col("_n") * share / F.lit(total)) + 1).cast("int").alias("parts"))


def is_small(df: DataFrame) -> bool:
    """Whether the table has at most ``SMALL_ROWS`` rows; reads no more of them than that."""
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", salt_by: Sequence[str] | None = None, share: int = HEAVY_SHARE
) -> DataFrame:
    """Inner or left join on ``keys``, with the left rows of heavy keys dealt over several parts of the key.

    The right rows of a heavy key are repeated once per part, all others stay single. Left rows with
    a null key match nothing and go anywhere. Where no key is heavy, this is a plain join. ``salt_by``
    names what tells a key's left rows apart; all its columns by default. The left side is read
    once more, for the counts, so it should be narrow or staged.
    """
    if how not in {"inner", "left"}:
        raise ValueError("only inner and left joins can spread their left side")
    # Bounded by the share, see heavy_keys.
    found = heavy_keys(left, keys, share)
    rows = found.collect()
    if not rows:
        return left.join(right, list(keys), how)
    heavy = F.broadcast(left.sparkSession.createDataFrame(rows, found.schema))
    parts = F.coalesce("parts", F.lit(1))
    unmatched = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = F.pmod(F.xxhash64(*(salt_by or left.columns)), F.when(unmatched, share).otherwise(parts).cast("long")).cast("int")
    dealt = left.join(heavy, list(keys), "left").withColumn("_part", salt).drop("parts")
    repeated = right.join(heavy, list(keys), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")
