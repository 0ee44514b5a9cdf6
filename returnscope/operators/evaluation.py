"""Metrics over score tables: ids, ``actual``, ``prediction`` and ``train_test``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN
from returnscope.operators.cleaning import describe
from returnscope.operators.ranking import running_total, smallest_ranks, value_ranks
from returnscope.sources.tables import stage


def _error() -> Column:
    return F.col("actual") - F.col("prediction")


def regression_metrics(scores: DataFrame) -> DataFrame:
    """Mean absolute error, root mean squared error and coefficient of determination."""
    return scores.agg(
        F.count("*").alias("n_observations"),
        F.avg(F.abs(_error())).alias("mae"),
        F.sqrt(F.avg(_error() * _error())).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(_error() * _error()), F.var_pop("actual") * F.count("actual"))).alias("r2"),
    )


def classification_metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 at a threshold, and the area under the ROC curve.

    ``scores`` has ``label`` (0/1) and ``probability`` of class 1. The area is exact: it follows
    from the rank sum of the positives, with equal probabilities counted half.
    """
    hit = F.col("probability") >= threshold
    positive = F.col("label") == 1
    counts = scores.agg(
        F.count("*").alias("n"),
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    )
    ranks = value_ranks(scores, [], "probability")
    positives = scores.groupBy("probability").agg(F.count_if(positive).alias("pos"))
    mid_rank = F.col("before") + (F.col("ties") + 1) / F.lit(2.0)
    area = ranks.join(positives, "probability").agg(
        F.sum(F.col("pos") * mid_rank).alias("rank_sum"),
        F.sum("pos").cast("double").alias("p"),
        F.sum(F.col("ties") - F.col("pos")).cast("double").alias("q"),
    )
    auc = F.try_divide(F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q"))
    # Both sides are a single row.
    joined = counts.withColumn("_one", F.lit(1)).join(area.select(F.lit(1).alias("_one"), auc.alias("roc_auc")), "_one")
    precision = F.try_divide("tp", F.col("tp") + F.col("fp"))
    recall = F.try_divide("tp", F.col("tp") + F.col("fn"))
    return joined.select(
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1_score"),
        "roc_auc",
    )


def value_pairs(scores: DataFrame) -> DataFrame:
    """Equal (split, actual, prediction) rows counted into one; all that the split metrics need."""
    pair = [F.col(SPLIT_COLUMN), F.col("actual").cast("double").alias("actual"), F.col("prediction").cast("double").alias("prediction")]
    return scores.select(*pair).groupBy(SPLIT_COLUMN, "actual", "prediction").agg(F.count("*").alias("w"))


def rank_correlation(scores: DataFrame) -> DataFrame:
    """Per split: correlation of the ranks of actual and prediction.

    Ranks are taken over all splits together, equal values share the smallest rank. Rows without an
    actual value or a prediction have no rank and take no part.
    """
    return _rank_correlation(stage(value_pairs(scores), "value_pairs"))


def _rank_correlation(pairs: DataFrame) -> DataFrame:
    """Both columns are ranked in one range sort, as one key each, and each pair's two ranks then meet under the pair.

    No join has a value as its key, so a label that is 0 almost always is no hot key.
    """
    pair = [SPLIT_COLUMN, "actual", "prediction"]
    ranked = pairs.filter(F.col("actual").isNotNull() & F.col("prediction").isNotNull())
    total = ranked.agg(F.sum("w")).scalar()
    # Larger values come first; 0 and -0 are one value.
    keys = [F.struct(F.lit(n).alias("kind"), (0.0 - F.col(c)).alias("value")) for n, c in enumerate(["actual", "prediction"])]
    ranked = smallest_ranks(ranked.withColumn("key", F.explode(F.array(*keys))), "key", pair, "w", "before")
    # Shifted by the middle rank, which keeps the sums of squares small.
    rank = (F.col("before") - F.col("key.kind") * total - F.floor(total / 2)).cast("double")
    of_kind = [F.sum(F.when(F.col("key.kind") == n, rank)).alias(c) for n, c in enumerate("ap")]
    ranked = ranked.groupBy(*pair).agg(F.first("w").alias("w"), *of_kind)
    a, p, w = F.col("a"), F.col("p"), F.col("w")
    sums = ranked.groupBy(SPLIT_COLUMN).agg(
        F.sum(w).alias("n"),
        F.sum(w * a).alias("sa"),
        F.sum(w * p).alias("sp"),
        F.sum(w * a * a).alias("saa"),
        F.sum(w * p * p).alias("spp"),
        F.sum(w * a * p).alias("sap"),
    )
    n = F.col("n")
    covariance = F.col("sap") - F.col("sa") * F.col("sp") / n
    spread_a = F.col("saa") - F.col("sa") * F.col("sa") / n
    spread_p = F.col("spp") - F.col("sp") * F.col("sp") / n
    return sums.select(
        SPLIT_COLUMN, F.try_divide(covariance, F.sqrt(spread_a * spread_p)).alias("spearman_rank_correlation_score")
    )


def split_metrics(scores: DataFrame) -> DataFrame:
    """Per split: number of rows, errors and rank correlation, from one pass over the scores."""
    pairs = stage(value_pairs(scores), "value_pairs")
    held = F.when(F.col("actual").isNotNull() & F.col("prediction").isNotNull(), F.col("w"))
    errors = pairs.groupBy(SPLIT_COLUMN).agg(
        F.sum("w").alias("n_observations"),
        F.sqrt(F.sum(held * _error() * _error()) / F.sum(held)).alias("rmse"),
        (F.sum(held * F.abs(_error())) / F.sum(held)).alias("mae"),
    )
    return errors.join(_rank_correlation(pairs), SPLIT_COLUMN, "left")


def tier_comparison(scores: DataFrame, ids: Sequence[str], tiers: int = 10) -> DataFrame:
    """Average actual and prediction per tier of equal size, best predictions in tier 1.

    Tiers are cut per split by the row's position in descending prediction; ids break ties.
    """
    slim = scores.select(SPLIT_COLUMN, *ids, F.col("actual").cast("double"), F.col("prediction").cast("double"), F.lit(1).alias("_one"))
    placed = running_total(slim, [F.col(SPLIT_COLUMN), F.col("prediction").desc(), *[F.col(c) for c in ids]], "_one", "_running")
    # One row per split.
    sizes = placed.groupBy(SPLIT_COLUMN).agg(F.min("_running").alias("_start"), F.count("*").alias("_n"))
    position = F.col("_running") - F.col("_start")
    size, larger = F.floor(F.col("_n") / tiers), F.col("_n") % tiers
    in_larger = larger * (size + 1)
    tier = F.when(position < in_larger, F.floor(position / (size + 1)) + 1).otherwise(
        larger + F.floor((position - in_larger) / F.greatest(size, F.lit(1))) + 1
    )
    return (
        placed.join(F.broadcast(sizes), SPLIT_COLUMN)
        .groupBy(SPLIT_COLUMN, tier.cast("long").alias("tier"))
        .agg(F.avg("actual").alias("tier_level_avg_actual"), F.avg("prediction").alias("tier_level_avg_prediction"))
    )


def prediction_distribution(scores: DataFrame) -> DataFrame:
    """Descriptive statistics of actual and prediction."""
    return describe(scores, ["actual", "prediction"])


def histogram(scores: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per bin of equal width; bins 0 and ``bins + 1`` hold what lies outside."""
    bin_number = F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins))
    return scores.groupBy(bin_number.alias("bin")).agg(F.count("*").alias("row_count"))


def adjusted_value(rows: DataFrame, value: str = "transaction_value", prediction: str = "prediction") -> DataFrame:
    """Conversion value to report: the transaction value less the refund expected for it."""
    return rows.withColumn("adjusted_conversion_value", F.col(value) - F.col(prediction))


def top_features(importance: DataFrame, limit: int | None = None) -> DataFrame:
    """Features by attribution, largest first."""
    ordered = importance.orderBy(F.col("attribution").desc(), F.col("feature"))
    return ordered if limit is None else ordered.limit(limit)
