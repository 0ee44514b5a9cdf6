"""Runs from event frames to stored models and predictions."""

import pytest
from pyspark.sql import functions as F

from registry.base import SOURCES
from returnscope.config import TRANSACTION_KEYS, ModelFamily
from returnscope.operators.modeling import SearchSpace
from returnscope.plans import run
from returnscope.sources import tables

DATA = "/root/testdata/sf0.001"


def test_a_run_from_export_to_prediction(spark, tmp_path):
    place = run.Place(str(tmp_path), "test_run")
    web, recent = SOURCES["web"], SOURCES["web_recent"]
    with pytest.raises(ValueError, match="no model"):
        run.prediction_run(recent.frames(spark, DATA), recent.window, place)
    staged = tables.staged_paths(spark)
    log = {r["segment"]: r for r in run.training_run(web.frames(spark, DATA), web.window, place, space=SearchSpace(trials=2)).collect()}
    assert set(log) == {"existing", "first_purchase"} and log["existing"]["status"] == "TRAINED"
    assert all(r["status"] == "TRAINED" or r["message"] for r in log.values())
    ready = run.read_result(spark, place, "existing", "refund_value", "ml_ready")
    assert ready.filter("train_test = 'train'").count() == log["existing"]["training_rows"] > 0
    assert run.read_result(spark, place, "existing", "refund_value", "trials", ModelFamily.LINEAR_REGRESSION).count() == 2
    assert run.read_result(spark, place, "existing", "refund_value", "tiers").count() > 0
    with pytest.raises(ValueError, match="stored no nothing"):
        run.read_result(spark, place, "existing", "refund_value", "nothing")

    predicted = run.prediction_run(recent.frames(spark, DATA), recent.window, place)
    first = {tuple(r) for r in predicted.collect()}
    days = predicted.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert str(recent.window.transaction_start) <= str(days[0]) <= str(days[1]) <= str(recent.window.end)
    assert predicted.filter("prediction IS NULL").count() == 0
    assert predicted.groupBy(*TRANSACTION_KEYS).count().filter("count > 1").count() == 0
    # A second run replaces the rows by the same ones, and nothing stays staged.
    assert {tuple(r) for r in run.prediction_run(recent.frames(spark, DATA), recent.window, place).collect()} == first
    assert tables.staged_paths(spark) == staged
    assert run.forget(spark, place, {"refund_value": ["tiers"]})
    assert run.forget(spark, place) and not [t for t in spark.catalog.listTables() if t.name.startswith("test_run_")]
