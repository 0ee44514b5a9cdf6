"""Refund-rate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from returnscope.config import SMOOTHING_WEIGHT


def smoothed_rate(hits: Column, prior: Column, trials: Column) -> Column:
    """Rate pulled towards ``prior`` as if it had been observed ``SMOOTHING_WEIGHT`` times.

    NULL in any input gives NULL, and so does a zero denominator.
    """
    weight = F.lit(SMOOTHING_WEIGHT)
    return F.try_divide(hits + prior * weight, trials + weight)


def refund_rate(hits: Column, prior: Column, trials: Column) -> Column:
    """Aggregate form: sums hits and trials over the group and averages the prior."""
    return smoothed_rate(F.sum(hits.cast("double")), F.avg(prior), F.sum(trials.cast("double")))


def is_positive(value: Column) -> Column:
    """1 when the value is present and above zero, else 0."""
    return F.when(value > 0, 1).otherwise(0).cast("long")
