"""Training, scoring and merging of refund models.

Linear and logistic models are solved from sums over the rows (:mod:`returnscope.operators.linear`), networks by
gradient steps (:mod:`returnscope.operators.network`), boosted trees by Spark ML, both with early stopping. All are searched for by the same logged loop. A fifth of
the training rows, by hash of their keys, is held out of the trials and judges them: by root mean squared
error, or by log loss for classifiers. The best trial's parameters are then fitted on all training rows.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.config import SPLIT_COLUMN, TRANSACTION_KEYS, ModelFamily, Split
from returnscope.functions.hashing import row_hash
from returnscope.operators import linear, network
from returnscope.operators.cleaning import melted_numbers
from returnscope.operators.search import run_trials
from returnscope.sources.tables import side_by_side, stage, stage_path

FEATURES = "features"
HELD_OUT = "_held_out"
# Rows in a block inside which permutation importance exchanges values.
BLOCK_ROWS = 256
# Fewest training rows that are worth a task of their own.
TASK_ROWS = 32_768


@dataclass(frozen=True)
class SearchSpace:
    """Ranges of the tuned parameters, and how many combinations to try."""

    l1: tuple[float, float] = (0.0, 10.0)
    l2: tuple[float, float] = (0.0, 10.0)
    learning_rate: tuple[float, float] = (0.0, 1.0)
    max_depth: tuple[int, int] = (1, 10)
    subsample: tuple[float, float] = (0.0, 1.0)
    column_sample: tuple[float, float] = (0.0, 1.0)
    boosting_rounds: int = 20
    # A round of a network is so many steps of its solver.
    network_rounds: int = 10
    network_steps: int = 10
    hidden_units: tuple[int, int] = (4, 16)
    batch_rows: tuple[int, int] = (16, 1024)
    # Rounds go on while the held-out loss falls by more than this share.
    tolerance: float = 0.01
    trials: int = 10
    seed: int = 42

    def draws(self, family: ModelFamily) -> list[dict[str, float]]:
        """One parameter set per trial; the first takes every lower bound, the others are random.

        A bound may be one that a model refuses, such as a learning rate of 0; that trial then fails, and the log says so.
        """
        rng = random.Random(self.seed)

        def number(bounds: tuple[float, float], first: bool) -> float:
            return bounds[0] if first else rng.uniform(*bounds)

        drawn = []
        for trial in range(self.trials):
            first = trial == 0
            if family in {ModelFamily.LINEAR_REGRESSION, ModelFamily.LOGISTIC_REGRESSION}:
                drawn.append({"l1": number(self.l1, first), "l2": number(self.l2, first)})
            elif family is ModelFamily.NEURAL_CLASSIFIER:
                drawn.append(
                    {
                        "learning_rate": number(self.learning_rate, first),
                        "hidden_units": int(number(self.hidden_units, first)),
                        "batch_rows": int(number(self.batch_rows, first)),
                    }
                )
            else:
                drawn.append(
                    {
                        "learning_rate": number(self.learning_rate, first),
                        "max_depth": int(round(number(self.max_depth, first))),
                        "subsample": number(self.subsample, first),
                        "column_sample": number(self.column_sample, first),
                    }
                )
        return drawn


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model, the log of its trials, what it was fitted on, and the weights of a linear one."""

    family: ModelFamily
    label: str
    features: list[str]
    pipeline: PipelineModel
    trials: DataFrame
    weights: dict[str, float] = field(default_factory=dict)

    @property
    def model(self) -> Model:
        return self.pipeline.stages[-1]


def feature_names(df: DataFrame, label: str) -> list[str]:
    """Everything that is neither key, split nor label."""
    return [c for c in df.columns if c not in {*TRANSACTION_KEYS, SPLIT_COLUMN, label}]


def held_out(seed: int) -> Column:
    """A fifth of the rows, by hash of their keys."""
    return row_hash(TRANSACTION_KEYS, seed) % 5 == 0


def train(df: DataFrame, label: str, family: ModelFamily, space: SearchSpace | None = None, log: str | None = None) -> TrainedModel:
    """Search on the training rows, then fit the best trial on all of them.

    ``log`` is the folder of the trial log; a search that was interrupted goes on from it. Rows must
    have no null feature or label.
    """
    space = space or SearchSpace()
    features = feature_names(df, label)
    rows = df.filter(F.col(SPLIT_COLUMN) == Split.TRAIN.value)
    search = {
        ModelFamily.LINEAR_REGRESSION: _linear,
        ModelFamily.LOGISTIC_REGRESSION: _logistic,
        ModelFamily.NEURAL_CLASSIFIER: _network,
    }.get(family, _trees)
    return search(rows, label, family, features, space, log or stage_path(df.sparkSession, "trials"))


def _searched(spark: SparkSession, family: ModelFamily, space: SearchSpace, attempt: Callable, log: str) -> tuple[DataFrame, dict, int]:
    """The trial log, and the best trial's parameters and rounds."""
    trials = run_trials(spark, space.draws(family), attempt, log)
    best = best_trial(trials).first()
    if best is None:
        raise ValueError(f"every trial failed, see the log at {log}")
    return trials, json.loads(best["hyperparameters"]), best["rounds"]


def _margin(features: Sequence[str], weights: Sequence[float], intercept: float) -> str:
    terms = [f"{float(w)!r}D * `{c}`" for c, w in zip(features, weights, strict=True) if w]
    return " + ".join([f"{float(intercept)!r}D", *terms])


def _formula(columns: str) -> PipelineModel:
    """A model that is a projection, saved and loaded like any other."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")])


def _linear(rows, label, family, features, space, log) -> TrainedModel:
    """One pass for all trials; where a side has no rows, the other serves for both."""
    sums = linear.moments(linear.design(rows, features, label, held_out(space.seed)))
    if not sums:
        raise ValueError("there are no training rows")
    fitted, judged = sums.get(0) or sums[1], sums.get(1) or sums[0]

    def attempt(p: Mapping[str, float]) -> tuple[float, int]:
        return linear.mean_squared_error(judged, *linear.elastic_net(fitted, p["l1"], p["l2"])) ** 0.5, 1

    trials, best, _ = _searched(rows.sparkSession, family, space, attempt, log)
    whole = sums[0] + sums[1] if len(sums) > 1 else fitted
    weights, intercept = linear.elastic_net(whole, best["l1"], best["l2"])
    pipeline = _formula(f"{_margin(features, weights, intercept)} AS prediction")
    return TrainedModel(family, label, features, pipeline, trials, dict(zip(features, map(float, weights), strict=True)))


def _logistic(rows, label, family, features, space, log) -> TrainedModel:
    """Every pass over the rows serves all trials."""
    x = stage(linear.design(_dealt(rows), features, label, held_out(space.seed)), "design")
    sums = linear.moments(x)
    if len(sums) < 2:
        raise ValueError("there are too few training rows to hold some out")
    draws = space.draws(family)
    # Spark ML's convention for both penalties.
    fits = linear.logistic(x, sums[0], [(p["l1"], p["l2"]) for p in draws])
    by_draw = {json.dumps(p, sort_keys=True): f for p, f in zip(draws, fits, strict=True)}

    def attempt(p: Mapping[str, float]) -> tuple[float, int]:
        fit = by_draw[json.dumps(p, sort_keys=True)]
        return fit.held_out_loss, fit.steps

    trials, best, _ = _searched(rows.sparkSession, family, space, attempt, log)
    near = by_draw[json.dumps(best, sort_keys=True)]
    start = [*near.weights, near.intercept]
    every = x.withColumn("held", F.lit(0))
    fit = linear.logistic(every, sums[0] + sums[1], [(best["l1"], best["l2"])], linear.np.array(start))[0]
    chance = f"1D / (1D + exp(-({_margin(features, fit.weights, fit.intercept)})))"
    pipeline = _formula(f"array(1D - {chance}, {chance}) AS probability, CAST({chance} > 0.5 AS DOUBLE) AS prediction")
    return TrainedModel(family, label, features, pipeline, trials, dict(zip(features, map(float, fit.weights), strict=True)))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores by hash of their keys.

    Small files and joined shuffle partitions leave few partitions, and every pass of an iterative fit
    would have as few tasks. Rows for a single task stay as they are, and so do rows that fill every core.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(cores, rows.count() // TASK_ROWS)
    if parts < 2 or rows.rdd.getNumPartitions() >= 4 * cores:
        return rows
    return rows.repartition(parts, *[c for c in TRANSACTION_KEYS if c in rows.columns])


def _vectors(rows: DataFrame, label: str, features: Sequence[str], seed: int) -> tuple[VectorAssembler, DataFrame]:
    """Assembled rows, persisted, since iterative fits read them many times."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    own = assembler.transform(_dealt(rows)).select(FEATURES, F.col(label).cast("double").alias(label), held_out(seed).alias(HELD_OUT))
    return assembler, own.persist()


def held_out_loss(scored: DataFrame, label: str, is_classifier: bool) -> float:
    """Log loss of the probabilities, or root mean squared error of the predictions; not a number without rows."""
    if is_classifier:
        # A probability of exactly 0 or 1 is taken as nearly that.
        p = F.least(F.greatest(vector_to_array("probability")[1], F.lit(1e-15)), F.lit(1 - 1e-15))
        loss = F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))
    else:
        loss = F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)))
    found = scored.agg(loss).first()[0]
    return float("nan") if found is None else float(found)


def _trees(rows, label, family, features, space, log) -> TrainedModel:
    """Boosting stops when the held-out error does not fall; the final fit takes as many rounds."""
    assembler, vectors = _vectors(rows, label, features, space.seed)
    kind = GBTRegressor if family is ModelFamily.BOOSTED_TREE_REGRESSOR else GBTClassifier

    def boosted(p: Mapping[str, float], rounds: int, **stop):
        return kind(
            featuresCol=FEATURES, labelCol=label, seed=space.seed, maxIter=rounds, maxDepth=p["max_depth"], stepSize=p["learning_rate"],
            subsamplingRate=p["subsample"], featureSubsetStrategy=f"{p['column_sample']:.3f}", **stop,
        )

    def attempt(p: Mapping[str, float]) -> tuple[float, int]:
        model = boosted(p, space.boosting_rounds, validationIndicatorCol=HELD_OUT, validationTol=space.tolerance).fit(vectors)
        return held_out_loss(model.transform(vectors.filter(HELD_OUT)), label, family.is_classifier), model.getNumTrees

    try:
        trials, best, rounds = _searched(rows.sparkSession, family, space, attempt, log)
        model = boosted(best, rounds).fit(vectors)
    finally:
        vectors.unpersist()
    return TrainedModel(family, label, features, PipelineModel([assembler, model]), trials)


def _network(rows, label, family, features, space, log) -> TrainedModel:
    """Each round goes on from the last one's weights, until the held-out loss does not fall; every pass serves all trials."""
    spark = rows.sparkSession
    x = network.packed(linear.design(_dealt(rows), features, label, held_out(space.seed)))

    def estimator(p: Mapping[str, float], **others):
        return MultilayerPerceptronClassifier(
            featuresCol=FEATURES, labelCol=label, seed=space.seed, solver="gd", layers=[len(features), p["hidden_units"], 2],
            stepSize=p["learning_rate"], blockSize=p["batch_rows"], maxIter=space.network_steps,
        ).setParams(**others)

    def net(p: Mapping[str, float]) -> network.Net:
        start = network.first_weights(spark, [len(features), p["hidden_units"], 2], space.seed)
        return network.Net(len(features), p["hidden_units"], p["learning_rate"], p["batch_rows"], start)

    draws = space.draws(family)
    # Spark ML refuses some parameters, and so do the trials that have them.
    nets = {json.dumps(p, sort_keys=True): net(p) for p in draws if p["learning_rate"] > 0 and p["batch_rows"] > 0 and p["hidden_units"] > 0}

    def attempt(p: Mapping[str, float]) -> tuple[float, int]:
        estimator(p)._transfer_params_to_java()
        losses = nets[json.dumps(p, sort_keys=True)].losses
        if not losses:
            raise ValueError("the held-out loss is not a number")
        return losses[-1], len(losses)

    try:
        if nets:
            network.advance(x, list(nets.values()), space.network_rounds, space.network_steps, space.tolerance)
        trials, best, rounds = _searched(spark, family, space, attempt, log)
        found = net(best)
        network.advance(x, [found], rounds, space.network_steps)
    finally:
        x.unpersist()
    # One step too small to move a weight makes a model of them.
    row = spark.createDataFrame([(Vectors.dense([0.0] * len(features)), 0.0)], [FEATURES, label])
    model = estimator(best, initialWeights=Vectors.dense(found.weights), maxIter=1, stepSize=1e-300).fit(row)
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    return TrainedModel(family, label, features, PipelineModel([assembler, model]), trials)


def best_trial(trials: DataFrame) -> DataFrame:
    """The lowest-numbered trial among those that succeeded and are optimal."""
    winner = trials.filter((F.col("status") == "SUCCEEDED") & F.col("is_optimal")).agg(F.min("trial_id").alias("trial_id"))
    return trials.join(winner, "trial_id", "left_semi")


def train_two_step(
    flags: DataFrame,
    values: DataFrame,
    flag: str,
    value: str,
    classifier: ModelFamily = ModelFamily.LOGISTIC_REGRESSION,
    regressor: ModelFamily = ModelFamily.LINEAR_REGRESSION,
    space: SearchSpace | None = None,
) -> tuple[TrainedModel, TrainedModel]:
    """A classifier for "is there a refund", and a regressor fitted only on rows that have one."""
    steps = [lambda: train(flags, flag, classifier, space), lambda: train(values.filter(F.col(value) > 0), value, regressor, space)]
    first, second = side_by_side(steps)
    return first, second


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_regression(model: Transformer, df: DataFrame, label: str | None = None) -> DataFrame:
    """Keys, prediction, and for labelled data the actual value and the split."""
    extra = [F.col(label).cast("double").alias("actual"), SPLIT_COLUMN] if label else []
    return model.transform(df).select(*TRANSACTION_KEYS, F.col("prediction").cast("double"), *extra)


def probabilities(df: DataFrame) -> Column:
    """Array of the classes' probabilities, whether a model gives a vector or an array."""
    return F.col("probability") if dict(df.dtypes)["probability"].startswith("array") else vector_to_array("probability")


def score_classifier(model: Transformer, df: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """One row per (transaction, class) whose probability is above the cut-off; class 1 also at the cut-off."""
    extra = [SPLIT_COLUMN] if SPLIT_COLUMN in df.columns else []
    scored = model.transform(df)
    return (
        scored.select(*TRANSACTION_KEYS, *extra, F.posexplode(probabilities(scored)).alias("label", "probability"))
        .filter((F.col("probability") > cutoff) | ((F.col("probability") == cutoff) & (F.col("label") == 1)))
    )


def positive_probability(model: Transformer, df: DataFrame, label: str) -> DataFrame:
    """Keys, true label and probability of class 1, as the classification metrics need them."""
    scored = model.transform(df)
    return scored.select(*TRANSACTION_KEYS, F.col(label).cast("int").alias("label"), probabilities(scored)[1].alias("probability"))


def decided_class(model: Transformer, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per transaction: class 1 from a probability of ``threshold`` on. Training and serving both decide here."""
    scored = model.transform(df)
    extra = [SPLIT_COLUMN] if SPLIT_COLUMN in df.columns else []
    refund = scored.select(*TRANSACTION_KEYS, *extra, probabilities(scored)[1].alias("probability"))
    return refund.withColumn("label", (F.col("probability") >= threshold).cast("int"))


def two_step_merge(classified: DataFrame, regressed: DataFrame, gate_on_label: bool = True, threshold: float = 0.5) -> DataFrame:
    """Expected refund: 0 where the classifier sees none, else the regression value.

    By default the predicted class decides. With ``gate_on_label=False`` the row's probability is
    compared with the threshold instead, whichever class it belongs to; a confident "no refund"
    then keeps its regression value, and low cut-offs give two rows per transaction.
    """
    no_refund = F.col("label") == 0 if gate_on_label else F.col("probability") < threshold
    extra = [c for c in [SPLIT_COLUMN] if c in classified.columns]
    actual = [c for c in ["actual"] if c in regressed.columns]
    values = regressed.select(*TRANSACTION_KEYS, *actual, F.col("prediction").alias("_value"))
    return classified.join(values, TRANSACTION_KEYS, "left").select(
        *TRANSACTION_KEYS, *extra, *actual, F.when(no_refund, F.lit(0.0)).otherwise(F.col("_value")).alias("prediction")
    )


def feature_importance(trained: TrainedModel, df: DataFrame) -> DataFrame:
    """(feature, attribution) of a trained model.

    Trees report their split gains; linear models the absolute coefficient times the feature's
    spread; other models their permutation importance.
    """
    spark, names = df.sparkSession, trained.features
    if hasattr(trained.model, "featureImportances"):
        weights = trained.model.featureImportances.toArray()
        return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights, strict=True)], "feature string, attribution double")
    if trained.weights:
        spread = {names[r[0]]: r[1] for r in melted_numbers(df, names).groupBy("place").agg(F.stddev_samp("value")).collect()}
        rows = [(n, abs(w) * float(spread.get(n) or 0.0)) for n, w in trained.weights.items()]
        return spark.createDataFrame(rows, "feature string, attribution double")
    return permutation_importance(trained, df)


def permutation_importance(trained: TrainedModel, df: DataFrame, seed: int = 0) -> DataFrame:
    """(feature, attribution): how much the mean loss grows when a feature's values are exchanged between rows.

    Works for every family: the loss is log loss for classifiers, squared error for others. Rows are
    dealt into small blocks by hash of their keys, in whose order a feature's values are shifted by a
    step drawn from block, feature and seed; blocks are thus the only thing that is shuffled. A row takes
    the values of its partners with it and leaves the block, and its variants exist one after another.
    """
    names, label, keys = trained.features, trained.label, [c for c in TRANSACTION_KEYS if c in df.columns]
    held = F.array(*[F.col(f"`{n}`").cast("double") for n in names])
    rows = df.select(row_hash(keys, seed).alias("place"), held.alias("x"), F.col(f"`{label}`").cast("double").alias("y"))
    blocks = F.greatest(F.ceil(rows.agg(F.count("*")).scalar() / BLOCK_ROWS), F.lit(1))
    block = rows.withColumn("block", F.xxhash64("place") % blocks)
    gathered = block.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "x", "y"))).alias("rows"))
    size = F.size("rows")
    steps = F.array(*[1 + F.pmod(F.xxhash64("block", F.lit(k + 1), F.lit(seed)), F.greatest(size - 1, F.lit(1)).cast("long")).cast("int") for k in range(len(names))])

    def leaving(row: Column, at: Column) -> Column:
        """The row, and feature by feature the value of its partner."""
        exchanged = F.transform("steps", lambda step, k: F.element_at("rows", ((at + step) % size + 1).cast("int"))["x"][k])
        return F.struct(row["x"].alias("x"), row["y"].alias("y"), exchanged.alias("exchanged"))

    each = gathered.select("rows", steps.alias("steps")).select(F.inline(F.transform("rows", leaving)))
    # Variant 0 is the row as it is, variant k has feature k - 1 from another row.
    varied = each.select("x", "y", "exchanged", F.explode(F.sequence(F.lit(0), F.lit(len(names)))).alias("variant"))
    values = [F.when(F.col("variant") == k + 1, F.col("exchanged")[k]).otherwise(F.col("x")[k]).alias(n) for k, n in enumerate(names)]
    scored = trained.pipeline.transform(varied.select("variant", F.col("y").alias("_label"), *values))
    if trained.family.is_classifier:
        p = F.least(F.greatest(probabilities(scored)[1], F.lit(1e-15)), F.lit(1 - 1e-15))
        loss = -F.when(F.col("_label") == 1, F.log(p)).otherwise(F.log(1 - p))
    else:
        loss = F.pow(F.col("_label") - F.col("prediction"), 2)
    losses = scored.groupBy("variant").agg(F.avg(loss).alias("loss"))
    # A row per feature, and one more.
    of_feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("variant"))
    base = F.broadcast(losses.filter("variant = 0").select(F.col("loss").alias("base"), F.lit(0).alias("_one")))
    grown = losses.filter("variant > 0").withColumn("_one", F.lit(0)).join(base, "_one")
    return grown.select(of_feature.alias("feature"), (F.col("loss") - F.col("base")).alias("attribution"))
