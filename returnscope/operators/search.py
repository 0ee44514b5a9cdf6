"""A search loop whose log is written trial by trial, so that a rerun goes on where the last one ended."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "trial_id int, hyperparameters string, validation_metric double, rounds int, status string, message string"
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """What a search has logged so far; empty where it has not begun."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def run_trials(
    spark: SparkSession, draws: Sequence[Mapping[str, float]], attempt: Callable[[Mapping[str, float]], tuple[float, int]], path: str
) -> DataFrame:
    """Try every parameter set and log it at once; returns the log with ``is_optimal``.

    ``attempt`` returns the loss on held-out rows and the rounds it took. A trial that raises, or whose
    loss is not a number, is logged as failed and the search goes on. Trials that the log already has,
    by number and parameters, aren't tried again.
    """
    texts = [json.dumps(dict(sorted(p.items()))) for p in draws]
    known = {(r["trial_id"], r["hyperparameters"]) for r in read_log(spark, path).collect()}
    for number, (parameters, text) in enumerate(zip(draws, texts, strict=True), 1):
        if (number, text) in known:
            continue
        try:
            loss, rounds = attempt(parameters)
            fine = math.isfinite(loss)
            row = (number, text, float(loss) if fine else None, rounds, SUCCEEDED if fine else FAILED, None if fine else "loss is not a number")
        except Exception as error:  # any trial may fail for reasons of its own; the log says which
            row = (number, text, None, None, FAILED, f"{type(error).__name__}: {error}"[:500])
        _logged(spark, row).write.mode("append").parquet(path)
    return with_optimal(read_log(spark, path))


def _logged(spark: SparkSession, row: Sequence) -> DataFrame:
    """One row of the log, from literals: a local list would start a Python worker for it."""
    fields = [field.split() for field in LOG_SCHEMA.split(", ")]
    return spark.range(1, numPartitions=1).select(*[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, fields, strict=True)])


def with_optimal(log: DataFrame) -> DataFrame:
    """``is_optimal``: whether no trial that succeeded has a smaller loss. A log has a row per trial."""
    fine = F.col("status") == SUCCEEDED
    least = log.filter(fine).agg(F.min("validation_metric")).scalar()
    return log.withColumn("is_optimal", fine & F.col("validation_metric").eqNullSafe(least))
