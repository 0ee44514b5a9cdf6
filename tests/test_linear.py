"""Models solved from sums, against Spark ML's fits and closed forms."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN, ModelFamily
from returnscope.operators import linear, modeling, network, search

PENALTIES = [(0.0, 0.0), (0.0, 0.7), (0.05, 0.0), (0.02, 0.3)]
FEATURES = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    """Features of unlike scales, one of them constant, a label that is linear and one that is a class."""
    r = spark.range(1_200).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("2024-01-01").cast("date").alias("transaction_date"),
        F.randn(1).alias("a"),
        (F.randn(2) * 40 + 900).alias("b"),
        (F.rand(3) / 100).alias("c"),
        F.lit(7.0).alias("same"),
        F.randn(4).alias("noise"),
        F.when(F.col("id") % 10 == 0, "test").otherwise("train").alias(SPLIT_COLUMN),
    )
    value = 3 * F.col("a") - 0.05 * F.col("b") + 100 * F.col("c") + F.col("noise") + 50
    flag = (2 * F.col("a") - 0.02 * (F.col("b") - 900) + F.col("noise") > 0.7).cast("int")
    kept = r.select("*", value.alias("value"), flag.alias("flag")).drop("noise").persist()
    yield kept
    kept.unpersist()


def spark_fit(estimator, rows, label, l1, l2):
    total = l1 + l2
    fit = estimator(labelCol=label, regParam=total, elasticNetParam=l1 / total if total else 0.0, tol=1e-10, maxIter=500)
    return fit.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


@pytest.mark.parametrize(("l1", "l2"), PENALTIES)
def test_least_squares_equal_spark_ml(rows, l1, l2):
    sums = linear.moments(linear.design(rows, FEATURES, "value", F.lit(0)))
    weights, intercept = linear.elastic_net(sums[0], l1, l2)
    theirs = spark_fit(LinearRegression, rows, "value", l1, l2)
    assert weights == pytest.approx(theirs.coefficients.toArray(), rel=1e-4, abs=1e-6)
    assert intercept == pytest.approx(theirs.intercept, rel=1e-4)
    assert linear.mean_squared_error(sums[0], weights, intercept) == pytest.approx(theirs.summary.meanSquaredError, rel=1e-6)


def test_logistic_fits_equal_spark_ml(rows):
    x = linear.design(rows, FEATURES, "flag", F.lit(0))
    fits = linear.logistic(x, linear.moments(x)[0], PENALTIES)
    for fit, (l1, l2) in zip(fits, PENALTIES, strict=True):
        theirs = spark_fit(LogisticRegression, rows, "flag", l1, l2)
        assert fit.weights == pytest.approx(theirs.coefficients.toArray(), rel=1e-3, abs=1e-4)
        assert fit.intercept == pytest.approx(theirs.intercept, rel=1e-3)
        assert fit.steps > 1


def test_moments_do_not_depend_on_partitions(rows):
    def of(n):
        return linear.moments(linear.design(rows.repartition(n), FEATURES, "value", F.col("transaction_id") % 5 == 0))

    one, many = of(1), of(70)
    for side in (0, 1):
        assert one[side].n == many[side].n
        assert many[side].cross == pytest.approx(one[side].cross, rel=1e-9, abs=1e-9)


def test_one_feature_without_penalty_is_the_regression_line(rows):
    space = modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1)
    model = modeling.train(rows.select("transaction_id", "transaction_date", SPLIT_COLUMN, "b", "value"), "value", ModelFamily.LINEAR_REGRESSION, space)
    slope, intercept = rows.filter(f"{SPLIT_COLUMN} = 'train'").agg(F.regr_slope("value", "b"), F.regr_intercept("value", "b")).first()
    assert model.weights == {"b": pytest.approx(slope, rel=1e-9)}
    scored = modeling.score_regression(model.pipeline, rows, "value").join(rows, "transaction_id")
    assert scored.filter(F.abs(F.col("prediction") - (F.col("b") * slope + intercept)) > 1e-6).count() == 0


def test_a_search_reads_the_rows_once(rows, spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = rows.mapInArrow(count, rows.schema)
    modeling.train(counted, "value", ModelFamily.LINEAR_REGRESSION)
    assert read.value == rows.count()


def test_separable_classes_and_nulls(rows):
    easy = rows.withColumn("flag", (F.col("a") > 0).cast("int")).drop("value")
    model = modeling.train(easy, "flag", ModelFamily.LOGISTIC_REGRESSION, modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1))
    right = modeling.decided_class(model.pipeline, easy).join(easy, "transaction_id").filter("label = flag").count()
    assert right > 0.98 * easy.count()
    with pytest.raises(Exception, match="must not be null"):
        modeling.train(rows.withColumn("a", F.lit(None).cast("double")), "value", ModelFamily.LINEAR_REGRESSION)


def test_models_are_saved_and_loaded(rows, tmp_path):
    for label, family in (("value", ModelFamily.LINEAR_REGRESSION), ("flag", ModelFamily.LOGISTIC_REGRESSION)):
        model = modeling.train(rows.drop("flag" if label == "value" else "value"), label, family)
        modeling.save_model(model.pipeline, f"{tmp_path}/{label}")
        again = modeling.load_model(f"{tmp_path}/{label}")
        assert again.transform(rows).select("prediction").exceptAll(model.pipeline.transform(rows).select("prediction")).count() == 0


def test_weights_of_nearly_equal_features_are_at_their_optimum():
    """Where features nearly repeat each other, sweeps alone hardly move: at the optimum no single weight would gain by moving."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 40))
    x[:, 20:] = x[:, :20] + rng.normal(size=(2000, 20)) * 1e-2
    y = x[:, :5].sum(axis=1) + rng.normal(size=2000)
    gram, target, l1, l2 = x.T @ x / 2000, x.T @ y / 2000, 1e-4, 1e-5
    free = np.zeros(40, bool)
    free[-1] = True
    w = linear.quadratic(gram, target, l1, l2, free)
    slope = gram @ w - target + np.where(free, 0, l2) * w
    bound = np.where(free, 0, l1)
    off = np.where(w != 0, np.abs(slope + bound * np.sign(w)), np.maximum(np.abs(slope) - bound, 0))
    assert off.max() < 1e-8 and 0 < np.count_nonzero(w) < 40


def test_passes_merge_the_same_sums_whatever_the_number_of_partitions(spark):
    rows = spark.range(4000).select(F.array(F.col("id") % 7 - 3.0, F.col("id") % 11 - 5.0).alias("x"), (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 5 == 0).cast("int").alias("held"))
    one, many = (linear.newton_sums(rows.repartition(n), np.zeros(2), np.ones(2), np.array([[0.1, -0.2, 0.3], [0.0, 0.0, 0.0]])) for n in (3, linear.BUCKETS + 6))
    assert set(one) == set(many) == {0, 1}
    for side in one:
        assert all(np.allclose(one[side][k], many[side][k]) for k in one[side])


# --- the search -------------------------------------------------------------------------------


def test_a_failing_trial_is_logged_and_the_search_goes_on(spark, tmp_path):
    tried = []

    def attempt(p):
        tried.append(p["x"])
        if p["x"] == 2:
            raise RuntimeError("no luck")
        return (float("nan") if p["x"] == 3 else abs(p["x"] - 5.0), p["x"])

    draws = [{"x": x} for x in (1, 2, 3, 4, 6)]
    log = search.run_trials(spark, draws, attempt, f"{tmp_path}/log")
    rows = {r["trial_id"]: (r["status"], r["validation_metric"], r["message"], r["is_optimal"]) for r in log.collect()}
    assert rows == {
        1: ("SUCCEEDED", 4.0, None, False),
        2: ("FAILED", None, "RuntimeError: no luck", False),
        3: ("FAILED", None, "loss is not a number", False),
        4: ("SUCCEEDED", 1.0, None, True),
        5: ("SUCCEEDED", 1.0, None, True),
    }
    assert modeling.best_trial(log).first()["trial_id"] == 4
    # A rerun takes the log as it is; new draws are tried.
    search.run_trials(spark, [*draws, {"x": 5}], attempt, f"{tmp_path}/log")
    assert tried == [1, 2, 3, 4, 6, 5]


def test_a_log_row_needs_no_python_worker(spark):
    logged = search._logged(spark, (1, '{"x": 1.5}', 0.25, 3, "SUCCEEDED", None))
    assert [f.simpleString() for f in logged.schema.fields] == [f.replace(" ", ":") for f in search.LOG_SCHEMA.split(", ")]
    assert [tuple(r) for r in logged.collect()] == [(1, '{"x": 1.5}', 0.25, 3, "SUCCEEDED", None)]
    plan = logged._jdf.queryExecution().executedPlan().toString()
    assert "Range" in plan and "RDD" not in plan


def test_an_interrupted_search_goes_on(spark, tmp_path):
    class Lost(BaseException):
        pass

    def attempt(p, lost=True):
        if p["x"] == 3 and lost:
            raise Lost
        return float(p["x"]), 1

    draws = [{"x": x} for x in range(5)]
    with pytest.raises(Lost):
        search.run_trials(spark, draws, attempt, f"{tmp_path}/log")
    assert search.read_log(spark, f"{tmp_path}/log").count() == 3
    again = search.run_trials(spark, draws, lambda p: attempt(p, False), f"{tmp_path}/log")
    assert [r["trial_id"] for r in again.orderBy("trial_id").collect()] == [1, 2, 3, 4, 5]


def test_nothing_succeeds(rows, tmp_path):
    space = modeling.SearchSpace(learning_rate=(0, 0), trials=2)
    with pytest.raises(ValueError, match="every trial failed"):
        modeling.train(rows.drop("flag"), "value", ModelFamily.BOOSTED_TREE_REGRESSOR, space, f"{tmp_path}/log")


# --- other families ---------------------------------------------------------------------------


@pytest.mark.parametrize("family", list(ModelFamily))
def test_every_family_learns_and_names_the_planted_feature(rows, family):
    label, other = ("flag", "value") if family.is_classifier else ("value", "flag")
    data = rows.drop(other, "b", "c").withColumn("a_noise", F.crc32("transaction_id") / 4e9)
    if family is ModelFamily.NEURAL_CLASSIFIER:
        data = data.drop("same")
    space = modeling.SearchSpace(l1=(0, 0.1), l2=(0, 0.1), learning_rate=(0.1, 1.0), max_depth=(2, 4), subsample=(0.7, 1), column_sample=(0.9, 1), trials=2, boosting_rounds=8)
    model = modeling.train(data, label, family, space)
    scored = model.pipeline.transform(data.filter(f"{SPLIT_COLUMN} = 'test'"))
    if family.is_classifier:
        mean = data.filter(f"{SPLIT_COLUMN} = 'train'").agg(F.avg(label)).first()[0]
        baseline = scored.agg(F.avg(-F.when(F.col(label) == 1, F.log(F.lit(mean))).otherwise(F.log(F.lit(1 - mean))))).first()[0]
        p = modeling.probabilities(scored)[1]
        loss = scored.agg(F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
    else:
        baseline, loss = scored.agg(F.var_pop(label), F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).first()
    assert loss < 0.9 * baseline
    importance = modeling.permutation_importance(model, data).orderBy(F.desc("attribution")).collect()
    assert importance[0]["feature"] == "a"
    assert all(abs(r["attribution"]) < 0.1 * importance[0]["attribution"] for r in importance[1:])
    assert modeling.feature_importance(model, data).orderBy(F.desc("attribution")).first()["feature"] == "a"


def test_boosting_stops_when_the_held_out_error_does(rows):
    space = modeling.SearchSpace(learning_rate=(1.0, 1.0), max_depth=(6, 6), subsample=(1, 1), column_sample=(1, 1), trials=1, boosting_rounds=15)
    model = modeling.train(rows.drop("flag"), "value", ModelFamily.BOOSTED_TREE_REGRESSOR, space)
    assert model.trials.first()["rounds"] == model.model.getNumTrees < 15
    assert np.isfinite(model.trials.first()["validation_metric"])


def test_the_threshold_decides_in_training_and_serving(rows):
    from returnscope.plans.models import predict_two_steps, train_two_steps

    values = rows.drop("flag").withColumn("value", F.abs("value"))
    for threshold in (0.2, 0.9):
        report = train_two_steps(rows.drop("value"), values, "flag", "value", threshold=threshold)
        served = predict_two_steps(report.models["classifier"].pipeline, report.models["regressor"].pipeline, rows, rows, threshold)
        pairs = report.scores.select("transaction_id", F.col("prediction").alias("p")).join(served, "transaction_id")
        assert pairs.count() == rows.count() and pairs.filter("abs(p - prediction) > 1e-9").count() == 0
    assert pairs.filter("prediction = 0").count() > 0


def test_one_file_of_rows_is_fitted_by_many_tasks(spark):
    few = spark.range(0, 100, 1, 1).select(F.col("id").cast("string").alias("transaction_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"), (F.col("id") + 0.0).alias("x"), F.col("id").alias("y"))
    many = few.limit(0).union(spark.range(0, 4 * modeling.TASK_ROWS, 1, 1).select(F.col("id").cast("string"), F.lit("2024-01-01").cast("date"), F.col("id") + 0.0, F.col("id"))).coalesce(1)
    parts = [modeling._vectors(rows, "y", ["x"], 42)[1].rdd.getNumPartitions() for rows in (few, many)]
    assert parts == [1, 4]


def test_importance_keeps_no_block_beside_its_rows(spark):
    rows = spark.range(64).select(F.col("id").cast("string").alias("transaction_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"), F.lit("train").alias("train_test"), (F.col("id") + 0.0).alias("x"), (F.col("id") * 2.0).alias("y"))
    model = modeling.train(rows, "y", ModelFamily.LINEAR_REGRESSION, modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1))
    plan = modeling.permutation_importance(model, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Generate" in line and "posexplode(rows" in line]


def test_blocks_are_sorted_without_a_lambda(spark):
    """A comparison through a lambda is interpreted."""
    rows = spark.range(64).select(F.col("id").cast("string").alias("transaction_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"), F.lit("train").alias("train_test"), (F.col("id") + 0.0).alias("x"), (F.col("id") * 2.0).alias("y"))
    model = modeling.train(rows, "y", ModelFamily.LINEAR_REGRESSION, modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1))
    plan = modeling.permutation_importance(model, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" in plan and "array_sort" not in plan


def test_network_trials_share_their_passes_and_step_as_spark_ml(spark, monkeypatch):
    """Whatever the number of trials, a pass serves all; weights and losses are those of Spark ML's rounds, partition by partition."""
    key = F.col("id").cast("string")
    made = spark.range(0, 900, 1, 3).select(
        key.alias("transaction_id"), F.lit("2024-01-01").cast("date").alias("transaction_date"), F.lit("train").alias(SPLIT_COLUMN),
        (F.col("id") % 7 / 7).alias("a"), (F.crc32(key) / 4.3e9).alias("b"), (F.col("id") % 7 > 3).cast("int").alias("flag"),
    )
    asked = []
    passed = network.passed
    monkeypatch.setattr(network, "passed", lambda rows, nets, *more: asked.append(len(nets)) or passed(rows, nets, *more))
    space = modeling.SearchSpace(learning_rate=(0.0, 1.0), batch_rows=(8, 40), trials=4, network_rounds=2, network_steps=3, tolerance=-1e9)
    model = modeling.train(made, "flag", ModelFamily.NEURAL_CLASSIFIER, space)
    # Three trials can be fitted; then the best one is, on all rows.
    assert asked == [3] * 7 + [1] * 6
    log = {r["trial_id"]: r for r in model.trials.collect()}
    assert log[1]["status"] == "FAILED" and "stepSize" in log[1]["message"]
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(made).withColumn("held", modeling.held_out(space.seed))

    def by_spark(p, data):
        fitted = None
        for _ in range(2):
            est = MultilayerPerceptronClassifier(labelCol="flag", seed=42, solver="gd", layers=[2, p["hidden_units"], 2], stepSize=p["learning_rate"], blockSize=p["batch_rows"], maxIter=3)
            fitted = (est if fitted is None else est.setInitialWeights(fitted.weights)).fit(data)
        return fitted

    for trial, p in enumerate(space.draws(ModelFamily.NEURAL_CLASSIFIER)[1:], 2):
        wanted = modeling.held_out_loss(by_spark(p, vectors.filter("NOT held")).transform(vectors.filter("held")), "flag", True)
        assert log[trial]["validation_metric"] == pytest.approx(wanted, rel=1e-9)
    best = next(p for n, p in enumerate(space.draws(ModelFamily.NEURAL_CLASSIFIER), 1) if log[n]["is_optimal"])
    assert np.allclose(model.model.weights.toArray(), by_spark(best, vectors).weights.toArray(), rtol=1e-9)


def test_a_network_without_rows_stays_as_it_is(spark):
    x = network.packed(spark.createDataFrame([], "x array<double>, y double, held int"))
    net = network.Net(2, 3, 0.5, 8, network.first_weights(spark, [2, 3, 2], 42))
    before = net.weights.copy()
    network.advance(x, [net], 2, 3, 0.01)
    assert (net.weights == before).all() and not net.losses


def test_the_driver_reads_a_row_a_side(rows, monkeypatch):
    """However many partitions there are; each row holds a matrix per trial."""
    read = []
    kind = type(rows)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: read.append(collect(df)) or read[-1])
    x = linear.design(rows.repartition(12), FEATURES, "flag", F.hash("transaction_id") % 2 == 0)
    sums = linear.newton_sums(x, np.zeros(4), np.ones(4), np.zeros((3, 5)))
    assert [len(r) for r in read] == [2]
    assert sums[0]["n"] + sums[1]["n"] == rows.count()
    one = linear.newton_sums(x.coalesce(1), np.zeros(4), np.ones(4), np.zeros((3, 5)))
    assert sums[1]["curve"] == pytest.approx(one[1]["curve"])
