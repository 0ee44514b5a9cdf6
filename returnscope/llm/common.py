"""Helpers shared by the text operators: reading, ASCII folding, word splitting, joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returnscope.sources.tables import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# White space as the contracts state it: space and the five ASCII controls from tab to return.
SPACES = r"[\x20\x09-\x0D]+"
# A key is hot when it holds more than one of so many rows; hence there are never more hot keys than this.
HOT_SHARE = 1024
# Bits of the filter in front of a semi-join: two megabytes.
FILTER_BITS = 1 << 24


def read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and every other character as it is.

    ``lower`` has a fast path for ASCII but also changes other letters, so only texts without any use it.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str) -> Column:
    """Non-empty pieces between runs of ``separators``; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list[tuple[object, int]]:
    """Keys with more than one of ``share`` rows, each with the number of parts to spread it over.

    There are at most ``share`` of them, and a part is about one of ``share`` rows, so the parts of
    all keys together are at most twice ``share``. Counts are summed on the map side first.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return hot_of_counts(counts, key, df.count(), share)


def hot_of_counts(counts: DataFrame, key: str, total: int, share: int = HOT_SHARE) -> list[tuple[object, int]]:
    """:func:`hot_keys` of a table with ``total`` rows, ``n`` of each ``key``."""
    rows = counts.filter((F.col("n") * share > total) & (F.col("n") > 1)).select(key, "n").collect()
    return [(r[0], r[1] * share // total + 1) for r in rows]


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: list[tuple[object, int]], salt_by: list[str], how: str = "inner") -> DataFrame:
    """Join on ``key`` with ``right`` unique by it, the rows of hot keys on the left spread over parts.

    ``hot`` comes from :func:`hot_keys` and so has a bounded size; the right row of a hot key is
    repeated once per part, every other row stays single.
    """
    if not hot:
        return left.join(right, key, how)
    kind = left.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("_parts", T.IntegerType())])
    table = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    parts = F.coalesce("_parts", F.lit(1))
    spread = left.join(table, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), parts.cast("long")).cast("int")).drop("_parts")
    repeated = right.join(table, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def narrowed(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` without most of the rows whose ``key`` isn't among ``keys``, so that a semi-join behind it shuffles less.

    The keys set bits of a filter that has a fixed size at most; no row whose key is among them is lost.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_BITS))
    bit = (place % 64).cast("int")
    word = F.floor(place / 64)
    words = keys.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marked = df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(words), "_word")
    return marked.filter(F.call_function("shiftright", F.col("_bits"), F.col("_bit")).bitwiseAND(F.lit(1)) == 1).drop("_word", "_bit", "_bits")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``key`` of all keys with several rows, nulls left out; written, as it is mostly empty."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return stage(counts.filter("_n > 1").select(key), "repeated_keys")


def with_spare_numbers(items: DataFrame, columns: list[str], taken: DataFrame) -> DataFrame:
    """``items``, distinct by ``columns``, each with a ``node`` of its own that isn't among the numbers of ``taken``.

    Nodes are hashes; the seed is changed until none meets another or a taken number.
    """
    used, seed = taken.select(F.col(taken.columns[0]).alias("node")), 0
    while True:
        named = stage(items.withColumn("node", F.xxhash64(*columns, F.lit(seed))), "spare_numbers")
        if named.groupBy("node").count().filter("count > 1").isEmpty() and named.join(used, "node", "left_semi").isEmpty():
            return named
        seed += 1
