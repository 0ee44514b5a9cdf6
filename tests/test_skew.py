"""Ranks and joins under keys that hold most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from returnscope.operators import evaluation
from returnscope.operators.ranking import smallest_ranks
from returnscope.operators.skew import heavy_keys, spread_join


@pytest.fixture
def without_adaption(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_by_task(df):
    # The last column is read, so that no join is left out as unused.
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.max(df.columns[-1]))
    return [r["n"] for r in tasks.collect()]


def test_ranks_equal_counting_whatever_the_ties(spark):
    rng = random.Random(1)
    rows = [(0.0 if rng.random() < 0.9 else rng.choice([-1.0, 0.5, rng.random()]), i, rng.randrange(1, 4)) for i in range(2_000)]
    ranked = smallest_ranks(spark.createDataFrame(rows, "v double, i long, w long"), "v", ["i"], "w", "before").collect()
    assert len(ranked) == len(rows)
    assert all(r["before"] == sum(w for v, _, w in rows if v < r["v"]) for r in ranked[::37])
    assert {(r["v"], r["before"]) for r in ranked} == {(v, sum(w for u, _, w in rows if u < v)) for v, _, _ in rows}


def test_one_value_over_all_partitions(spark):
    ranked = smallest_ranks(spark.range(500).select(F.lit(7).alias("v"), "id", F.lit(1).alias("w")), "v", ["id"], "w", "before")
    assert {r["before"] for r in ranked.collect()} == {0}


def scores(spark, n=20_000):
    split = F.when(F.col("id") % 10 == 0, "test").otherwise("train")
    actual = F.when(F.rand(3) < 0.9, F.lit(0.0)).otherwise(F.round(F.rand(4) * 50))
    return spark.range(n).select(split.alias("train_test"), actual.alias("actual"), F.rand(5).alias("prediction"))


def test_rank_correlation_of_mostly_zeros_is_even(without_adaption):
    frame = scores(without_adaption)
    found = {r["train_test"]: r["spearman_rank_correlation_score"] for r in evaluation.rank_correlation(frame).collect()}
    data = frame.toPandas()
    ranks = data[["actual", "prediction"]].rank(method="min", ascending=False)
    for split, part in data.groupby("train_test"):
        own = ranks.loc[part.index]
        assert found[split] == pytest.approx(own["actual"].corr(own["prediction"]), abs=1e-9)
    pairs = evaluation.value_pairs(frame).withColumn("key", F.col("actual"))
    dealt = rows_by_task(smallest_ranks(pairs, "key", ["train_test", "prediction"], "w", "before"))
    assert max(dealt) < 4 * sum(dealt) / 4


def test_null_scores_take_no_part(spark):
    rows = [("train", 1.0, 2.0), ("train", 3.0, 1.0), ("train", None, 9.0), ("train", 4.0, None)]
    frame = spark.createDataFrame(rows, "train_test string, actual double, prediction double")
    got = evaluation.split_metrics(frame).first()
    assert (got["n_observations"], got["rmse"], got["mae"]) == (4, pytest.approx(2.5**0.5), 1.5)
    assert got["spearman_rank_correlation_score"] == pytest.approx(-1.0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_join_on_one_heavy_key_is_spread(without_adaption, how):
    spark = without_adaption
    key = F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 300))
    left = spark.range(20_000).select("id", F.when(F.col("id") == 5, F.lit(None)).otherwise(key).alias("k"))
    right = left.select("k").distinct().filter("k <> 'k10'").withColumn("v", F.length("k"))
    plain, spread = left.join(right, "k", how), spread_join(left, right, ["k"], how, ["id"])
    assert sorted(map(tuple, spread.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)
    dealt = rows_by_task(spread)
    assert max(dealt) < 2 * sum(dealt) / 4 < max(rows_by_task(plain))
    assert [r["k"] for r in heavy_keys(left, ["k"], 100).collect()] == ["hot"]


def test_only_left_rows_can_be_spread(spark):
    with pytest.raises(ValueError, match="inner and left"):
        spread_join(spark.range(1), spark.range(1), ["id"], "full")


def test_even_keys_are_joined_without_parts(without_adaption):
    left = without_adaption.range(4_000).select((F.col("id") % 2_000).alias("k"), "id")
    right = without_adaption.range(2_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = spread_join(left, right, ["k"], "left")
    assert joined.columns == ["k", "id", "v"] and joined.count() == 4_000 and joined.filter("v <> 2 * k OR v IS NULL").count() == 0
    assert "_part" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_a_short_product_history_moves_items_once(without_adaption):
    from returnscope.operators import features

    days = [(f"2024-01-0{d}", n, 10.0 * d, 1.0 * d) for d in (1, 2, 3) for n in ("a", "b")]
    daily = without_adaption.createDataFrame(days, "day string, item_name string, item_revenue double, item_refund double").select(
        F.col("day").cast("date").alias("transaction_date"), "item_name", "item_revenue", "item_refund"
    )
    sales = [("2024-01-03", "a", "i"), ("2024-01-03", "a", "i"), ("2024-01-03", "b", "i"), ("2024-01-02", "a", "j")]
    stats = without_adaption.createDataFrame(sales, "day string, item_name string, item_id string").select(F.col("day").cast("date").alias("transaction_date"), "item_name", "item_id")
    history = features.past_product_history(stats, daily)
    assert sorted(map(tuple, history.drop("transaction_date").collect())) == [("i", 6, 6, 9.0, 90.0), ("j", 1, 1, 1.0, 10.0)]
    assert history._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
