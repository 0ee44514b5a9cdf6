"""Exact deduplication over an extendible-hash index in shared files. DataFrame functions only.

1. Every row's text is normalised and hashed once; the digests are written to the shared folder.
2. The directory: distinct hashes are counted by their leading bits. A bucket that holds more than
   ``capacity`` of them is split by doubling, that is by one more bit, down to ``MAX_DEPTH`` bits.
3. The index: owner tasks take the keys of a bucket, chain the texts that share a hash, and tell
   them apart by comparing bytes. An entry keeps the smallest id and the number of rows. Entries are
   written by key range, a file per range of buckets.
4. Rows find their entry by hash and digest; rows of hot entries (over 1/1024 of all) are spread.

Copies collapse before the shuffle, so a group with a third of all rows costs its owner one row per
map task. A directory has at most ``2 ** MAX_DEPTH`` cells, whatever the input, so it may be broadcast.

Cases: a null text counts as empty, and empty texts are equal to each other. A null id never wins
over another; a group without any id has a null ``keep_id``. Rows that repeat both id and text have
the same decision. An empty table gives an empty result. Columns of the input that bear a name used
here don't matter: only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.llm.common import SPACES, hot_keys, salted_join
from returnscope.sources.tables import stage

MAX_DEPTH = 16
FIRST_DEPTH = 2


def normalised(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """Local depth and bucket of every cell of ``MAX_DEPTH`` leading bits, from distinct keys in ``h``.

    The first depth at which a cell's prefix holds no more than ``capacity`` keys is the depth at
    which doubling stops for it.
    """
    cells = keys.groupBy(F.shiftrightunsigned("h", 64 - MAX_DEPTH).cast("int").alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(FIRST_DEPTH), F.lit(MAX_DEPTH))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {MAX_DEPTH} - depth)")
    filled = levels.withColumn("prefix", prefix).withColumn("filled", F.sum("n").over(Window.partitionBy("depth", "prefix")))
    settled = filled.filter((F.col("filled") <= capacity) | (F.col("depth") == MAX_DEPTH))
    return settled.groupBy("cell").agg(F.min("depth").alias("depth")).select(
        "cell", "depth", F.expr(f"shiftleft(shiftright(cell, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)").alias("bucket")
    )


def build_index(rows: DataFrame, digests: DataFrame, capacity: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Entries ``bucket, depth, h, sha, chain, keep_id, group_size``, written by key range.

    ``rows`` has ``id, h, norm``; ``digests`` has ``h`` of the same rows.
    """
    cells = F.broadcast(keep(directory(digests.select("h").distinct(), capacity), "directory"))
    owned = rows.groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    entries = owned.select("h", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    chained = entries.withColumn("chain", F.row_number().over(Window.partitionBy("h").orderBy("sha")))
    placed = chained.withColumn("cell", F.shiftrightunsigned("h", 64 - MAX_DEPTH).cast("int")).join(cells, "cell").drop("cell")
    return keep(placed.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h"), "index")


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 100_000,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """``id, h, text_sha256, keep_id, group_size, chain`` for every row; ``h`` hashes the normalised text."""
    rows = docs.select(F.col(id_column).alias("id"), normalised(text_column).alias("norm")).withColumn("h", F.xxhash64("norm"))
    digests = keep(rows.select("id", "h", F.sha2("norm", 256).alias("sha")), "digests")
    index = build_index(rows, digests, capacity, keep).select("h", "sha", "chain", "keep_id", "group_size")
    hot = hot_keys(digests, "h")
    # A hot hash is one entry but for chained collisions, which the digest tells apart.
    entries = index.withColumnRenamed("sha", "entry_sha")
    found = salted_join(digests, entries, "h", hot, ["id"]).filter(F.col("sha") == F.col("entry_sha"))
    return found.select("id", "h", F.col("sha").alias("text_sha256"), "keep_id", "group_size", "chain")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows that stay, with the input's columns. Copies of a group without any id all stay."""
    dropped = (
        exact_groups(docs, id_column, text_column, **options)
        .filter(~F.col("id").eqNullSafe(F.col("keep_id")))
        .select(F.col("id").alias("_dropped"), F.col("h").alias("_gone"))
        .distinct()
    )
    keyed = docs.withColumn("_h", F.xxhash64(normalised(text_column)))
    gone = F.col(f"`{id_column}`").eqNullSafe(F.col("_dropped")) & (F.col("_h") == F.col("_gone"))
    return keyed.join(dropped, gone, "left_anti").drop("_h")
