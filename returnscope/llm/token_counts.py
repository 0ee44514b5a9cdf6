"""Token counts from an exact length histogram.

Every text is encoded once with a public byte-level vocabulary. Documents are aggregated by encoded
length; sums over the lengths above answer, for every context limit, how many documents fit, how
many tokens there are in all, and how many are left when each document is cut at the limit.

The histogram has a row per distinct length. Suffix sums run over ranges of lengths and then over the
ranges' totals, so that no task sees more than a range, however many lengths there are.

Cases: null and empty texts have length 0. Special tokens' strings are ordinary text. Repeated rows
each count. An empty table has an empty histogram. Other columns aren't read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.sources.tables import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RANGE = 1_024


@cache
def encoder(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(
    docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """``length`` of every row. ``vocabulary`` is a file that every executor has at the same path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["length"])

    return docs.select(F.col(text_column).alias("text")).mapInArrow(run, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """``length, n_docs, n_tokens`` and, counting the documents longer than ``length``, ``docs_above, tokens_above``."""
    counts = lengths.groupBy("length").agg(F.count("*").alias("n_docs"))
    counts = stage(counts.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("range", F.floor(F.col("length") / RANGE)), "lengths")
    totals = counts.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    # One row per range of lengths that occurs: the longest text's length over RANGE at most.
    later = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = totals.select("range", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t"))
    inside = Window.partitionBy("range").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("di", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
        .withColumn("ti", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(after, "range")
        .select("length", "n_docs", "n_tokens", (F.col("di") + F.col("d")).alias("docs_above"), (F.col("ti") + F.col("t")).alias("tokens_above"))
    )


def by_limit(counts: DataFrame) -> DataFrame:
    """Adds what a context limit of ``length`` leaves: ``docs_within``, ``kept_tokens`` and ``share_within``.

    ``share_within`` is the share of documents of this length or less: the quantile it answers.
    """
    docs, tokens = counts.agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    within = F.lit(docs or 0) - F.col("docs_above")
    return counts.select(
        "length", "n_docs", "n_tokens", "docs_above", "tokens_above", within.alias("docs_within"),
        (F.lit(tokens or 0) - F.col("tokens_above") + F.col("docs_above") * F.col("length")).alias("kept_tokens"),
        (within / F.lit(docs or 1)).alias("share_within"),
    )


def quantile(counts: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share ``q`` of documents doesn't exceed."""
    row = by_limit(counts).filter(F.col("share_within") >= q).agg(F.min("length")).first()
    return row[0]
