"""Scoring of model-ready rows as they arrive, for the daily prediction run.

A fitted pipeline is a plain projection over its input, so the same model scores a stream. Each
run takes what arrived since the last one and stops; the checkpoint remembers what was done, so
a rerun after a failure neither skips nor repeats rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from returnscope.operators.modeling import score_regression


def arriving_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def score_arrivals(model: PipelineModel, rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write keys and predictions of all new rows to ``out``."""
    return (
        score_regression(model, rows)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
