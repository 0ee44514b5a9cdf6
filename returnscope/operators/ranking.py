"""Running totals and positions over a global order, without a single-task sort.

A window without a partition key would put the whole table into one task. Here rows are spread
over range partitions (or equal hash buckets) first, the totals of the earlier partitions, a table
with one row per partition, are added up separately, and each partition runs its own window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returnscope.functions.hashing import row_hash
from returnscope.sources.tables import stage

# Hash positions use the upper half of the 32-bit hash as bucket.
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS


def running_total(df: DataFrame, order_by: Sequence[Column], amount: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows before this one in the given order.

    The order must be unique per row, which also keeps the range partitions balanced: equal
    values have been counted into one row, or an id breaks the tie. The partitioned rows are
    staged because the offsets and the rows must come from the same partitioning, also after
    executors are lost.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(df.repartitionByRange(parts, *order_by).withColumn("_part", F.spark_partition_id()), "range_partitions")
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum(amount).alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(by_part), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        # One row per shuffle partition, hence always small enough to broadcast.
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.coalesce(F.sum(amount).over(within), F.lit(0)) + F.col("_offset"))
        .drop("_part", "_offset")
    )


def smallest_ranks(df: DataFrame, key: str, tie_break: Sequence[str], amount: str, name: str) -> DataFrame:
    """Add ``name``: the ``amount`` of all rows with a smaller ``key``; equal keys share it.

    Rows are spread over range partitions by key and then ``tie_break``, which makes them unique, so
    that a key held by most rows is cut over many partitions. Inside a partition the first row of a
    key tells; a key at a partition's edge may have begun earlier, and the few such keys, two a
    partition, are looked up in a table of where they begin.
    """
    # More partitions than tasks, since the partitions' numbers are dealt to the tasks by hash.
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [key, *tie_break]
    placed = stage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "range_partitions")
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum(amount).alias("_total"), F.min(key).alias("_least"), F.max(key).alias("_most"))
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(by_part), F.lit(0)))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begun = F.min("_running").over(Window.partitionBy("_part", key))
    counted = (
        placed.withColumn("_running", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .withColumn("_begun", begun)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_begun", F.col("_begun") + F.col("_offset"))
    )
    # A key that ends one partition and starts the next ones begins in the first of them.
    last = placed.join(F.broadcast(offsets), "_part").filter(F.col(key) == F.col("_most"))
    ends = last.groupBy("_part", key).agg((F.max("_offset") + F.max("_total") - F.sum(amount)).alias("_first"))
    first = ends.groupBy(key).agg(F.min("_first").alias("_first"))
    starts = F.col(key) == F.col("_least")
    return (
        counted.withColumn("_edge", F.when(starts, F.col(key)))
        .join(F.broadcast(first.withColumnRenamed(key, "_edge")), "_edge", "left")
        .withColumn(name, F.coalesce(F.least("_first", "_begun"), "_begun"))
        .drop("_part", "_offset", "_total", "_least", "_most", "_running", "_begun", "_first", "_edge")
    )


def hash_position(df: DataFrame, ids: Sequence[str], name: str, seed: int = 0) -> DataFrame:
    """Add ``name``: the 1-based position of the row in a seeded random order of its ids.

    The hash is uniform, so its leading bits split the rows into equal buckets whatever the data;
    the bucket counts are at most ``BUCKETS`` rows. Ids must be unique per row.
    """
    hashed = df.withColumn("_hash", row_hash(ids, seed)).withColumn("_bucket", F.shiftright("_hash", BUCKET_BITS))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_bucket").orderBy("_hash", *ids)
    return (
        hashed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.row_number().over(within) + F.col("_offset"))
        .drop("_hash", "_bucket", "_offset")
    )


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False, extra: Sequence[Column] = ()) -> DataFrame:
    """Per (keys, value): ``ties`` (rows with the value), ``before`` (rows ranked ahead) and ``total``.

    All counts are within the keys. Equal values are counted before ordering, so a value shared by
    most rows is one row here. ``extra`` are further aggregates per value, from the same pass.
    """
    if not keys:
        return value_ranks(df.withColumn("_all", F.lit(0)), ["_all"], value, descending, extra).drop("_all")
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("ties"), *extra)
    order = [*[F.col(k) for k in keys], F.col(value).desc() if descending else F.col(value).asc()]
    ranked = running_total(counts, order, "ties", "_running")
    groups = ranked.groupBy(*keys).agg(F.min("_running").alias("_start"), F.sum("ties").alias("total"))
    return ranked.join(groups, list(keys)).withColumn("before", F.col("_running") - F.col("_start")).drop("_running", "_start")
