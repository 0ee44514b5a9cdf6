"""From raw documents to a mix: toxicity, exact copies, near copies, benchmark passages, source weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller writes it and hands what it
reads back to the next. Hence a stage may delete what the stages before it have staged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from returnscope.llm.common import read
from returnscope.llm.queries import learnt_from
from returnscope.sources.tables import checkpoint_dir, release_staged, staged_paths

_own: dict[str, list[str]] = {}


def _stage(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Release what this pipeline's earlier stages have staged, and note what this one stages."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        release_staged(spark, _own.pop(app, []))
        before = set(staged_paths(spark))
        out = step(spark, docs, sf_dir)
        _own[app] = [p for p in staged_paths(spark) if p not in before]
        return out

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from labelled documents of the stage's input that aren't held out."""
    model = toxicity.train(docs, learnt_from(read(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    return near_dedup.one_per_group(docs)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often it takes them."""
    mixed = mixing.mix(docs).filter("copies > 0")
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# A fitted model, near-duplicate links and balanced sampling have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read back."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        path = f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/pipeline-{name}"
        step(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
