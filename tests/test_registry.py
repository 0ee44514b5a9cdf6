"""Registered queries against their SQL, and properties of their plans.

The default run takes a cross-section on the smallest data; ``ALL_QUERIES=1`` runs every query.
"""

import math
import os
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from registry import all_queries, tables
from returnscope.operators import modeling
from returnscope.plans import models

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = all_queries()
CROSS_SECTION = [
    "past_user", "past_user_item_web", "past_product_history_web", "past_by_country_recent", "demographic_rates_web",
    "traffic_rates", "event_grid", "assemble_features_recent", "describe_labels", "select_binary_label", "resample",
    "split_ordered", "classification_metrics", "split_metrics", "tier_comparison", "random_row_id", "pipeline_roundtrip",
]
HISTORY = [n for n in QUERIES if n.startswith(("past_", "rolling", "demographic_rates", "brand_category", "traffic_rates"))]

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
            return None
        return value.item() if hasattr(value, "item") else value

    columns = sorted(frame.columns)
    rows = [tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _names():
    chosen = QUERIES if os.environ.get("ALL_QUERIES") else CROSS_SECTION
    return [n for n in chosen if QUERIES[n].sql is not None]


@pytest.mark.parametrize("name", _names())
def test_same_rows_as_sql(spark, duck, name):
    query = QUERIES[name]
    got, want = query.build(spark, DATA).toPandas(), duck.sql(query.sql).df()
    spark.catalog.clearCache()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", HISTORY)
def test_history_has_no_pairwise_join(spark, name):
    plan = QUERIES[name].build(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_only_fitted_models_lack_sql():
    without = {n for n, q in QUERIES.items() if q.sql is None}
    assert without <= {
        "train_linear", "train_logistic", "train_gbt", "train_gbt_classifier", "train_mlp",
        "train_one_step", "train_two_step", "score_regression", "score_classifier", "feature_importance", "predict_two_step",
        "training_log", "ml_ready_existing", "ml_ready_first_purchase", "stored_results", "daily_prediction",
    }


@pytest.mark.parametrize(
    "name",
    ["train_linear", "train_logistic", "train_gbt", "train_mlp", "train_one_step", "train_two_step", "score_regression", "score_classifier", "best_trial", "feature_importance", "predict_two_step"],
)
def test_models_are_searched_for_as_by_default(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def train(df, label, family, space=None, log=None):
        raise Asked(space or modeling.SearchSpace())

    class Prepared:
        tables = {label: spark.range(1).withColumn(label, F.lit(1)) for label in ("refund_flag", "refund_value")}

    monkeypatch.setattr(modeling, "train", train)
    monkeypatch.setattr(models, "train", train)
    monkeypatch.setattr(tables, "_training", lambda *_: Prepared)
    with pytest.raises(Asked) as asked:
        QUERIES[name].build(spark, DATA)
    assert asked.value.args == (modeling.SearchSpace(),)
