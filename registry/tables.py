"""Queries over order rows: sources, cleaning, selection, splitting, resampling, metrics, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.base import Query, table_query
from returnscope.config import SPLIT_COLUMN, LabelType, Labels, ModelFamily, PipelineMode, artifact_name
from returnscope.functions.rates import smoothed_rate
from returnscope.operators import cleaning, evaluation, modeling, resampling, selection, splitting
from returnscope.operators.encoding import Encoder
from returnscope.operators.ranking import hash_position
from returnscope.operators.search import read_log, with_optimal
from returnscope.operators.sparse import SparseEncoder, unfolded
from returnscope.plans.models import predict_two_steps, train_one_step, train_two_steps
from returnscope.plans.preprocess import FittedPreprocessing, prepare_prediction, prepare_training
from returnscope.sources.bindings import order_lines, table
from returnscope.sources.columns import clean_column_names, sink_safe_columns
from returnscope.streaming.daily_scoring import arriving_rows, score_arrivals
from returnscope.sources.tables import drop_tables, limited, read_csv, read_table, side_by_side, stage, stage_path, write_table

IDS = ["transaction_id", "transaction_date"]
LABELS = Labels()
NUMBERS = ["shipping_value", "transaction_value", "item_count", "total_quantity", "max_discount", "rarely_set", "always_seven"]
STRINGS = ["priority", "status"]


def order_profile(spark: SparkSession, directory: str) -> DataFrame:
    """One labelled row per order, with gaps: orders without lines, unknown statuses, rare flags."""
    lines = order_lines(spark, directory).groupBy("l_orderkey").agg(
        F.sum("item_revenue").alias("transaction_value"),
        F.coalesce(F.sum("item_refund"), F.lit(0.0)).alias("refund_value"),
        F.count("*").alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.max("discount_percent").alias("max_discount"),
    )
    key = F.col("o_orderkey")
    return (
        table(spark, directory, "orders")
        .join(lines, key == F.col("l_orderkey"), "left")
        .select(
            key.cast("string").alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            "refund_value",
            F.when(F.col("refund_value") > 0, 1).when(F.col("refund_value").isNotNull(), 0).alias("refund_flag"),
            F.try_divide("refund_value", "transaction_value").alias("refund_proportion"),
            F.when(key % 3 == 1, 0).when(key % 3 == 2, key % 100).alias("shipping_value"),
            "transaction_value",
            "item_count",
            "total_quantity",
            "max_discount",
            F.when(key % 50 == 0, 1).otherwise(0).alias("rarely_set"),
            F.lit(7).alias("always_seven"),
            F.col("o_orderpriority").alias("priority"),
            F.when(F.col("o_orderstatus") == "P", "unknown").when(F.col("o_orderstatus") == "O", "open").alias("status"),
        )
    )


def complete_profile(spark: SparkSession, directory: str) -> DataFrame:
    return cleaning.impute(cleaning.coerce_types(order_profile(spark, directory)))


def scores(spark: SparkSession, directory: str) -> DataFrame:
    """A score table computed from the order rows, with many ties."""
    key = F.col("transaction_id").cast("long")
    return complete_profile(spark, directory).select(
        *IDS,
        F.col("refund_value").alias("actual"),
        F.round(F.col("transaction_value") * 0.25 / 1e8).alias("prediction"),
        "transaction_value",
        F.col("refund_flag").cast("int").alias("label"),
        ((key * 37 % 700 + F.col("refund_flag").cast("long") * 300) / 1000).alias("probability"),
        F.when(key % 10 == 0, "test").otherwise("train").alias(SPLIT_COLUMN),
    )


BLOCKS = {
    "prof": """
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date, refund_value,
               CASE WHEN refund_value > 0 THEN 1 WHEN refund_value IS NOT NULL THEN 0 END AS refund_flag,
               refund_value / nullif(transaction_value, 0) AS refund_proportion,
               CASE WHEN o_orderkey % 3 = 1 THEN 0 WHEN o_orderkey % 3 = 2 THEN o_orderkey % 100 END AS shipping_value,
               transaction_value, item_count, total_quantity, max_discount,
               CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS rarely_set, 7 AS always_seven,
               o_orderpriority AS priority, CASE WHEN o_orderstatus = 'P' THEN 'unknown' WHEN o_orderstatus = 'O' THEN 'open' END AS status
        FROM orders LEFT JOIN (
            SELECT l_orderkey, sum(rev) AS transaction_value, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN rev END), 0) AS refund_value,
                   count(*) AS item_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
                   max(CAST(round(l_discount * 100) AS BIGINT)) AS max_discount
            FROM (SELECT *, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS rev FROM lineitem)
            GROUP BY 1) ON l_orderkey = o_orderkey""",
    "filled": "SELECT transaction_id, transaction_date, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in [*LABELS.all, *NUMBERS])
    + ", "
    + ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in STRINGS)
    + " FROM prof",
    "sc": """
        SELECT transaction_id, transaction_date, refund_value AS actual, round(transaction_value * 0.25 / 1e8) AS prediction, transaction_value,
               CAST(refund_flag AS INT) AS label,
               (CAST(transaction_id AS BIGINT) * 37 % 700 + CAST(refund_flag AS BIGINT) * 300) / 1000 AS probability,
               CASE WHEN CAST(transaction_id AS BIGINT) % 10 = 0 THEN 'test' ELSE 'train' END AS train_test
        FROM filled""",
    "melted": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, CAST(refund_flag AS INT) AS y FROM filled" for c in NUMBERS
    ),
    "ranked": """
        SELECT feature, y, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r,
               count(*) OVER (PARTITION BY feature, value) AS t, count(*) OVER (PARTITION BY feature) AS n
        FROM melted""",
    "tested": """
        SELECT feature, (12.0 / (n * (n + 1)) * (r1 * r1 / nullif(n1, 0) + r0 * r0 / nullif(n - n1, 0)) - 3.0 * (n + 1))
                        / nullif(1.0 - tied / (n * n * n - n), 0) AS h
        FROM (SELECT feature, CAST(max(n) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS n1, sum(CASE WHEN y = 1 THEN r ELSE 0 END) AS r1,
                     sum(CASE WHEN y = 0 THEN r ELSE 0 END) AS r0, CAST(sum(t * t - 1) AS DOUBLE) AS tied
              FROM ranked GROUP BY feature)""",
}

_CHECKED = [*LABELS.all, *NUMBERS]
_TEXT = ["transaction_id", *STRINGS]


def _invalid(c: str) -> str:
    if c in _CHECKED:
        return f"(CASE WHEN {c} IS NULL OR {c} = 0 THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {c} IS NULL OR {c} IN ('unknown', 'Unassigned', 'unassigned') THEN 1 ELSE 0 END)"


_ROW_SHARE = "(" + " + ".join(_invalid(c) for c in [*_CHECKED, *_TEXT]) + f") / {len(_CHECKED) + len(_TEXT)}"
_SHARES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum({_invalid(c)}) AS BIGINT) AS invalid_count, sum({_invalid(c)}) / count(*) AS invalid_share FROM filled"
    for c in [*_CHECKED, *_TEXT]
)
_HASH = "CAST('0x' || substr(md5('{seed}|' || transaction_id), 1, 8) AS BIGINT)"
_SPLIT = """CASE WHEN row_number() OVER (ORDER BY transaction_date DESC, transaction_id DESC)
    <= (SELECT CAST(floor(0.1 * count(*)) AS BIGINT) FROM {rows}) THEN 'test' ELSE 'train' END"""
_LEVELS = {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "status": ["open", "unknown"]}


def _encoded_sql(source: str, keep: str, numbers: list[str], strings: list[str]) -> str:
    """Encoded columns with ranges from the training rows of ``source``."""
    marks = [
        f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS cat_{c}_{v.lower().replace('-', '_').replace(' ', '_')}"
        for c in strings
        for v in _LEVELS[c]
    ]
    low = "min({c}) FILTER (WHERE train_test = 'train') OVER ()"
    high = "max({c}) FILTER (WHERE train_test = 'train') OVER ()"
    scaled = [
        f"({c} - {low.format(c=c)}) / CASE WHEN {high.format(c=c)} > {low.format(c=c)} THEN {high.format(c=c)} - {low.format(c=c)} ELSE 1 END AS num_{c}"
        for c in numbers
    ]
    return f"SELECT {keep}, {', '.join([*marks, *scaled])} FROM ({source})"


def _describe_sql(columns: list[str], rows: str) -> str:
    stats = {
        "count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})",
        "25%": "quantile_cont({c}, 0.25)", "50%": "quantile_cont({c}, 0.5)", "75%": "quantile_cont({c}, 0.75)", "max": "max({c})",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS statistic, {', '.join(text.format(c=c) + ' AS ' + c for c in columns)} FROM {rows}" for name, text in stats.items()
    )


def _split_rows(s: SparkSession, d: str) -> DataFrame:
    """Order rows tagged by the last digit of the id."""
    key = F.col("transaction_id").cast("long")
    return complete_profile(s, d).withColumn(SPLIT_COLUMN, F.when(key % 10 == 0, "test").otherwise("train"))


_TAGGED = "SELECT *, CASE WHEN CAST(transaction_id AS BIGINT) % 10 = 0 THEN 'test' ELSE 'train' END AS train_test FROM filled"
_SCALED = ["transaction_value", "item_count", "total_quantity", "max_discount", "shipping_value"]
_SCALED_DIGITS = {f"num_{c}": 9 for c in _SCALED}


# Numeric features that reach the minimal correlation, or are significant, for both labels of the order rows at every size of the tables.
_SELECTED = ["transaction_value", "item_count", "total_quantity", "max_discount"]
_SELECTED_DIGITS = {f"num_{c}": 9 for c in _SELECTED}
_CLEANED = f"WITH cleaned AS (SELECT * FROM filled WHERE {_ROW_SHARE} <= 0.5) "


def _encode(s: SparkSession, d: str, numbers: list[str], strings: list[str], roundtrip: bool = False) -> DataFrame:
    rows = _split_rows(s, d)
    encoder = Encoder.fit(rows.filter(F.col(SPLIT_COLUMN) == "train"), numbers, strings)
    if roundtrip:
        path = stage_path(s, "preprocessing")
        FittedPreprocessing(IDS, LABELS, selection.FeatureSelector({}), {"refund_value": encoder}, []).save(s, path)
        encoder = FittedPreprocessing.load(s, path).encoders["refund_value"]
    return encoder.transform(rows, [*IDS, SPLIT_COLUMN])


def _sparse(s: SparkSession, d: str) -> DataFrame:
    """Numbers and levels, every customer a level of its own, encoded by a reloaded encoder and unfolded into entries."""
    rows = stage(_split_rows(s, d).join(_customers(s, d), "transaction_id"), "tagged")
    path = stage_path(s, "sparse_encoder")
    SparseEncoder.fit(rows.filter(F.col(SPLIT_COLUMN) == "train"), _SCALED, [*STRINGS, "customer"]).save(s, path)
    encoder = SparseEncoder.load(s, path)
    encoded = stage(encoder.transform(rows, IDS, [SPLIT_COLUMN]), "sparse_rows")
    numbers = s.createDataFrame([(n, c) for n, c in enumerate(encoder.ranges)], "position long, column string")
    names = encoder.levels.unionByName(numbers, allowMissingColumns=True)
    return unfolded(encoded, names, [*IDS, SPLIT_COLUMN], "positions", ["values"]).withColumnRenamed("values", "value").withColumnRenamed("column", "feature")


def _customers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("transaction_id"), F.col("o_custkey").cast("string").alias("customer"))


def _read_back(s: SparkSession, d: str) -> DataFrame:
    """Written, replaced by rows derived from the old ones, and extended: the customers twice."""
    name = "returnscope_customers"
    drop_tables(s, [name])
    customers = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    write_table(customers.unionByName(customers), name)
    write_table(read_table(s, name).distinct(), name)
    write_table(customers, name, append=True)
    return read_table(s, name)


_SPARSE_ROWS = f"""
    SELECT t.*, CAST(o_custkey AS VARCHAR) AS customer FROM ({_TAGGED}) t JOIN orders ON CAST(o_orderkey AS VARCHAR) = transaction_id"""
_SPARSE_SQL = " UNION ALL ".join(
    [f"""SELECT transaction_id, transaction_date, train_test, '{c}' AS feature, {c} AS level, 1.0 AS value FROM ({_SPARSE_ROWS})
         WHERE {c} IN (SELECT {c} FROM ({_SPARSE_ROWS}) WHERE train_test = 'train')""" for c in [*STRINGS, "customer"]]
    + [f"""SELECT transaction_id, transaction_date, train_test, '{c}' AS feature, NULL AS level, num_{c} AS value
           FROM ({_encoded_sql(_TAGGED, "transaction_id, transaction_date, train_test", [c], [])}) WHERE num_{c} <> 0""" for c in _SCALED]
)


def _selected(s: SparkSession, d: str) -> DataFrame:
    """(label, feature) pairs chosen by the fitted selector."""
    rows = stage(complete_profile(s, d), "profile")
    fitted = selection.FeatureSelector.fit(rows, IDS, LABELS)
    pairs = [(label, c) for label, columns in fitted.columns.items() for c in columns if c in NUMBERS]
    return s.createDataFrame(pairs, "label string, feature string")


def _numeric_sql(label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}) = 0 THEN NULL ELSE covar_pop({c}, {label}) / (stddev_pop({c}) * stddev_pop({label})) END AS correlation FROM filled"
        for c in NUMBERS
    )


def _training(s: SparkSession, d: str, keep=stage):
    return prepare_training(order_profile(s, d), IDS, LABELS, keep=keep)


def _fit(label: str, family: ModelFamily):
    def run(s: SparkSession, d: str) -> tuple[modeling.TrainedModel, DataFrame]:
        rows = _training(s, d).tables[label]
        return modeling.train(rows, label, family, modeling.SearchSpace()), rows

    return run


def _regression_scores(family: ModelFamily):
    def run(s, d):
        model, rows = _fit("refund_value", family)(s, d)
        return evaluation.split_metrics(modeling.score_regression(model.pipeline, rows, "refund_value"))

    return run


def _classifier_metrics(family: ModelFamily):
    def run(s, d):
        model, rows = _fit("refund_flag", family)(s, d)
        test = rows.filter(F.col(SPLIT_COLUMN) == "test")
        return evaluation.classification_metrics(modeling.positive_probability(model.pipeline, test, "refund_flag"))

    return run


def _one_feature(s: SparkSession, d: str) -> DataFrame:
    """What can be fitted in SQL too: an intercept, one weight, and two penalties."""
    return _split_rows(s, d).select(*IDS, SPLIT_COLUMN, "transaction_value", "refund_value")


def _line(s: SparkSession, d: str) -> DataFrame:
    """Predictions of the unpenalised fit on one feature."""
    space = modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1)
    rows = _one_feature(s, d)
    model = modeling.train(rows, "refund_value", ModelFamily.LINEAR_REGRESSION, space)
    return modeling.score_regression(model.pipeline, rows, "refund_value")


def _streamed(s: SparkSession, d: str) -> DataFrame:
    """The same line's predictions, made as rows arrive in a folder: half of them, then the rest, each scored once."""
    rows = _one_feature(s, d)
    space = modeling.SearchSpace(l1=(0, 0), l2=(0, 0), trials=1)
    model = modeling.train(rows, "refund_value", ModelFamily.LINEAR_REGRESSION, space).pipeline
    place = stage_path(s, "arrivals")
    first = F.col("transaction_id").cast("long") % 2 == 0
    for arrived in (first, ~first):
        rows.filter(arrived).write.mode("append").parquet(f"{place}/in")
        score_arrivals(model, arriving_rows(s, f"{place}/in", rows.schema), f"{place}/out", f"{place}/seen").awaitTermination()
    return s.read.parquet(f"{place}/out")


def _from_csv(s: SparkSession, d: str) -> DataFrame:
    """Orders written as text with missing values marked, and read back by schema."""
    day, price = F.col("o_orderdate").cast("date"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice"))
    rows = table(s, d, "orders").select("o_orderkey", day.alias("o_orderdate"), price.alias("o_totalprice"), "o_orderpriority")
    path = stage_path(s, "orders_csv")
    rows.write.csv(path, header=True, nullValue="n/a", dateFormat="M/d/yyyy")
    return read_csv(s, path, rows.schema, "M/d/yyyy")


def _trial_log(s: SparkSession, d: str) -> DataFrame:
    """The log that a search has written, read back."""
    log = stage_path(s, "trials")
    modeling.train(_one_feature(s, d), "refund_value", ModelFamily.LINEAR_REGRESSION, modeling.SearchSpace(), log)
    return with_optimal(read_log(s, log))


_LINE_SQL = f"""
    SELECT transaction_id, transaction_date, refund_value AS actual, train_test, intercept + slope * transaction_value AS prediction
    FROM ({_TAGGED}), (SELECT regr_slope(refund_value, transaction_value) AS slope, regr_intercept(refund_value, transaction_value) AS intercept
                       FROM ({_TAGGED}) WHERE train_test = 'train')"""
# On one standardised feature the penalised fit has a closed form: the correlation, drawn towards 0 and shrunk.
_TRIALS_SQL = f"""
    WITH draws(trial_id, l1, l2) AS (VALUES {", ".join(f"({n}, {p['l1']!r}::DOUBLE, {p['l2']!r}::DOUBLE)" for n, p in enumerate(modeling.SearchSpace().draws(ModelFamily.LINEAR_REGRESSION), 1))}),
    r AS (SELECT transaction_value AS x, refund_value AS y,
                 CAST('0x' || substr(md5('42|' || transaction_id || '|' || transaction_date), 1, 8) AS BIGINT) % 5 = 0 AS held
          FROM ({_TAGGED}) WHERE train_test = 'train'),
    m AS (SELECT corr(y, x) AS c, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my FROM r WHERE NOT held),
    w AS (SELECT trial_id, sign(c) * greatest(abs(c) - l1 / sy, 0) / (1 + l2 / sy) * sy / sx AS slope, mx, my FROM draws, m),
    e AS (SELECT trial_id, sqrt(avg(pow(y - my - slope * (x - mx), 2))) AS validation_metric FROM w, r WHERE held GROUP BY 1)
    SELECT trial_id, validation_metric, 1 AS rounds, 'SUCCEEDED' AS status, validation_metric = min(validation_metric) OVER () AS is_optimal FROM e"""
_FAMILIES = {
    ModelFamily.LINEAR_REGRESSION: "refund_value", ModelFamily.BOOSTED_TREE_REGRESSOR: "refund_value",
    ModelFamily.LOGISTIC_REGRESSION: "refund_flag", ModelFamily.BOOSTED_TREE_CLASSIFIER: "refund_flag", ModelFamily.NEURAL_CLASSIFIER: "refund_flag",
}


def _families(s: SparkSession, d: str) -> DataFrame:
    """Per family: whether the held-out loss of the search is below that of always predicting the training mean."""
    tables = _training(s, d).tables

    def judged(family: ModelFamily, label: str) -> tuple:
        found = modeling.train(tables[label], label, family, modeling.SearchSpace())
        loss = modeling.best_trial(found.trials).first()["validation_metric"]
        mean = tables[label].filter(F.col(SPLIT_COLUMN) == "train").withColumn("_held", modeling.held_out(42))
        y, p = F.col(label), mean.filter("NOT _held").agg(F.avg(label)).first()[0]
        baseline = F.avg(-F.when(y == 1, F.log(F.lit(p))).otherwise(F.log(F.lit(1 - p)))) if family.is_classifier else F.sqrt(F.avg((y - p) * (y - p)))
        return family.value, loss < mean.filter("_held").agg(baseline).first()[0], found.trials.count()

    rows = side_by_side([lambda f=f, label=label: judged(f, label) for f, label in _FAMILIES.items()])
    return s.createDataFrame(rows, "family string, beats_mean boolean, trials long")


def _importances(s: SparkSession, d: str) -> DataFrame:
    """Permutation importance of a label that one feature decides: whether it comes first, and others stay far below."""
    rows = _split_rows(s, d).withColumn("noise", F.crc32("transaction_id") / 4.3e9).withColumn("planted", F.col("item_count") + 0.0)
    both = rows.withColumn("value", 5 * F.col("planted")).withColumn("flag", (F.col("planted") > 3).cast("int"))
    # Each family reads them several times.
    both = stage(both.select(*IDS, SPLIT_COLUMN, "noise", "planted", "value", "flag"), "planted")

    def found(family: ModelFamily) -> tuple:
        label = "flag" if family.is_classifier else "value"
        data = both.select(*IDS, SPLIT_COLUMN, "noise", "planted", label)
        space = modeling.SearchSpace(l1=(0, 0.1), l2=(0, 0.1), learning_rate=(0.3, 1.0), max_depth=(3, 5), subsample=(0.7, 1), column_sample=(1, 1), trials=2)
        grown = {r["feature"]: r["attribution"] for r in modeling.permutation_importance(modeling.train(data, label, family, space), data).collect()}
        return family.value, grown["planted"] > 0, abs(grown["noise"]) < 0.1 * grown["planted"]

    return s.createDataFrame(side_by_side([lambda f=f: found(f) for f in _FAMILIES]), "family string, planted_first boolean, noise_far_below boolean")


def _two_steps(s, d, part):
    tables = _training(s, d).tables
    report = train_two_steps(
        tables["refund_flag"], tables["refund_value"], "refund_flag", "refund_value", space=modeling.SearchSpace()
    )
    return part(report, tables)


def _predicted(s: SparkSession, d: str) -> DataFrame:
    """The prediction path: fitted preprocessing and models reloaded, applied to all orders."""
    training = _training(s, d)
    tables = training.tables
    first, second = modeling.train_two_step(
        tables["refund_flag"], tables["refund_value"], "refund_flag", "refund_value", space=modeling.SearchSpace()
    )
    place = stage_path(s, artifact_name(PipelineMode.TRAINING, "orders", "refund_value", "model", second.family))
    training.fitted.save(s, f"{place}/preprocessing")
    modeling.save_model(first.pipeline, f"{place}/classifier")
    modeling.save_model(second.pipeline, f"{place}/regressor")
    fitted = FittedPreprocessing.load(s, f"{place}/preprocessing")
    rows = prepare_prediction(order_profile(s, d), fitted)
    return predict_two_steps(
        modeling.load_model(f"{place}/classifier"), modeling.load_model(f"{place}/regressor"), rows["refund_flag"], rows["refund_value"]
    )


def _resample(strategy: resampling.Strategy):
    return lambda s, d: resampling.resample(
        complete_profile(s, d), "rarely_set", LabelType.CATEGORICAL, ["transaction_id"], strategy=strategy
    ).select(*IDS, "rarely_set")


_RESAMPLE_UNDER = f"""
    SELECT transaction_id, transaction_date, rarely_set FROM (
        SELECT *, row_number() OVER (PARTITION BY rarely_set ORDER BY {_HASH.format(seed=0)}, transaction_id) AS p,
               (SELECT count(*) FROM filled WHERE rarely_set = 1) AS few FROM filled)
    WHERE rarely_set = 1 OR p <= few"""
_RESAMPLE_OVER = f"""
    SELECT f.transaction_id, f.transaction_date, f.rarely_set FROM (
        SELECT *, row_number() OVER (PARTITION BY rarely_set ORDER BY {_HASH.format(seed=0)}, transaction_id) AS p,
               (SELECT count(*) FROM filled WHERE rarely_set = 1) AS few, (SELECT count(*) FROM filled WHERE rarely_set = 0) AS many FROM filled) f
    JOIN (SELECT unnest(range(1, 1000)) AS i) c
      ON c.i <= CASE WHEN f.rarely_set = 0 THEN 1 ELSE f.many // f.few + CASE WHEN f.p <= f.many % f.few THEN 1 ELSE 0 END END"""


def _two_step_inputs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Class rows above a 0.4 cut-off, both classes of a transaction where both pass, and values."""
    base = scores(s, d)
    classes = F.array(
        F.struct(F.lit(0).alias("label"), (1 - F.col("probability")).alias("probability")),
        F.struct(F.lit(1).alias("label"), F.col("probability").alias("probability")),
    )
    classified = base.select(*IDS, SPLIT_COLUMN, F.inline(classes)).filter(F.col("probability") > 0.4)
    return classified, base.select(*IDS, "actual", "prediction")


def _two_step_sql(gate: str) -> str:
    return f"""
        SELECT c.transaction_id, c.transaction_date, c.train_test, v.actual, CASE WHEN {gate} THEN 0.0 ELSE v.prediction END AS prediction
        FROM (SELECT transaction_id, transaction_date, train_test, 0 AS label, 1 - probability AS probability FROM sc
              UNION ALL SELECT transaction_id, transaction_date, train_test, 1, probability FROM sc) c
        LEFT JOIN sc v ON v.transaction_id = c.transaction_id AND v.transaction_date = c.transaction_date WHERE c.probability > 0.4"""


_ERRORS = "sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse, avg(abs(actual - prediction)) AS mae"
_SPEARMAN = """SELECT train_test, corr(ra, rp) AS spearman_rank_correlation_score FROM (
    SELECT train_test, rank() OVER (ORDER BY actual DESC) AS ra, rank() OVER (ORDER BY prediction DESC) AS rp FROM sc) GROUP BY 1"""
_NAMED = {"Order key (o)": "order_key_o", " Status/now ": "status_now", "Cust--No.": "cust_no", "_Total__Price_": "total_price"}


def _renamed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice").toDF(*_NAMED)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    def add(name, build, body, digits=None, dates=()):
        q[name] = table_query(build, body, digits, dates, BLOCKS)

    day = ("transaction_date",)
    # Sources, sinks and names.
    add("read_limit", lambda s, d: limited(table(s, d, "orders").select("o_orderkey", "o_totalprice"), 100, ["o_orderkey"]), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
    add("write_table", _read_back, "SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer")
    add("read_csv", _from_csv, "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS o_totalprice, o_orderpriority FROM orders", dates=("o_orderdate",))
    add("clean_column_names", lambda s, d: clean_column_names(_renamed(s, d)), "SELECT o_orderkey AS order_key_o, o_orderstatus AS status_now, o_custkey AS cust_no, o_totalprice AS total_price FROM orders")
    add("sink_safe_columns", lambda s, d: sink_safe_columns(_renamed(s, d)), "SELECT o_orderkey AS order_key__o_, o_orderstatus AS status_now_, o_custkey AS cust__no_, o_totalprice AS total__price_ FROM orders")

    # Scalar functions.
    add(
        "string_functions",
        lambda s, d: table(s, d, "customer").select(
            "c_custkey",
            F.concat("c_name", F.lit("_"), "c_mktsegment").alias("joined"),
            F.lower(F.regexp_replace("c_name", r"[\W_]+", "_")).alias("cleaned"),
            F.col("c_mktsegment").rlike("^(.*ch.*|AUTO.*)$").alias("matched"),
            F.col("c_mktsegment").endswith("ING").alias("ends"),
        ),
        "SELECT c_custkey, c_name || '_' || c_mktsegment AS joined, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g')) AS cleaned, regexp_matches(c_mktsegment, '^(.*ch.*|AUTO.*)$') AS matched, c_mktsegment LIKE '%ING' AS ends FROM customer",
    )
    add(
        "date_functions",
        lambda s, d: table(s, d, "events").select(
            "event_id",
            F.to_date(F.date_format("ts", "yyyyMMdd"), "yyyyMMdd").alias("day"),
            F.date_add(F.col("ts").cast("date"), -31).alias("window_start"),
            F.try_to_timestamp(F.concat(F.date_format("ts", "yyyy-"), F.lit("13-01")), F.lit("yyyy-MM-dd")).cast("date").alias("bad_date"),
            F.date_diff(F.lit("2024-02-01").cast("date"), F.col("ts").cast("date")).cast("long").alias("age"),
        ),
        "SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - 31 AS window_start, TRY_CAST(strftime(ts, '%Y-') || '13-01' AS DATE) AS bad_date, date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS age FROM events",
        dates=("day", "window_start", "bad_date"),
    )
    add(
        "null_safe_math",
        lambda s, d: order_profile(s, d).select(
            "transaction_id",
            F.try_divide("refund_value", "shipping_value").alias("quotient"),
            F.coalesce("shipping_value", F.lit(0)).alias("filled"),
            F.sqrt(F.abs(F.col("item_count") - 3)).alias("root"),
            smoothed_rate(F.col("refund_flag"), F.lit(0.5), F.col("item_count")).alias("smoothed"),
        ),
        "SELECT transaction_id, refund_value / nullif(shipping_value, 0) AS quotient, coalesce(shipping_value, 0) AS filled, sqrt(abs(item_count - 3)) AS root, (refund_flag + 0.5 * 0.2) / (item_count + 0.2) AS smoothed FROM prof",
        {"quotient": 4, "root": 9, "smoothed": 9},
    )

    # Cleaning.
    cast = "transaction_id, transaction_date, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CHECKED) + ", " + ", ".join(STRINGS)
    add("coerce_types", lambda s, d: cleaning.coerce_types(order_profile(s, d)), f"SELECT {cast} FROM prof", {"refund_proportion": 9}, day)
    add("impute", complete_profile, "SELECT * FROM filled", {"refund_proportion": 9}, day)
    add("invalid_share", lambda s, d: cleaning.column_invalid_shares(complete_profile(s, d)), _SHARES, {"invalid_share": 9})
    add(
        "invalid_summary",
        lambda s, d: cleaning.invalid_summary(complete_profile(s, d)),
        f"""SELECT count(*) AS row_count, CAST({len(_CHECKED) + len(_TEXT) + 1} AS BIGINT) AS column_count,
                   count(CASE WHEN {_ROW_SHARE} > 0.5 THEN 1 END) AS invalid_row_count,
                   (SELECT count(*) FROM ({_SHARES}) WHERE invalid_share > 0.95) AS invalid_column_count,
                   (SELECT coalesce(string_agg(column_name, ', '), '') FROM ({_SHARES}) WHERE invalid_share > 0.95) AS invalid_columns
            FROM filled""",
    )
    add("drop_invalid_rows", lambda s, d: cleaning.drop_invalid_rows(complete_profile(s, d)), f"SELECT * FROM filled WHERE {_ROW_SHARE} <= 0.5", {"refund_proportion": 9}, day)
    kept = ", ".join([*IDS, *LABELS.all, *[c for c in [*NUMBERS, *STRINGS] if c != "rarely_set"]])
    add("drop_invalid_columns", lambda s, d: cleaning.drop_invalid_columns(complete_profile(s, d), IDS, LABELS.all), f"SELECT {kept} FROM filled", {"refund_proportion": 9}, day)
    add("drop_constant_columns", lambda s, d: cleaning.drop_constant_columns(complete_profile(s, d), IDS, LABELS.all), "SELECT * EXCLUDE (always_seven) FROM filled", {"refund_proportion": 9}, day)
    add("clean_training", lambda s, d: cleaning.clean(order_profile(s, d), IDS, LABELS, training=True), f"SELECT {kept} FROM filled WHERE {_ROW_SHARE} <= 0.5", {"refund_proportion": 9}, day)
    add("describe_labels", lambda s, d: cleaning.describe(complete_profile(s, d), LABELS.all), _describe_sql(LABELS.all, "filled"), {"refund_value": 2, "refund_flag": 6, "refund_proportion": 6})

    # Selection.
    add("select_numeric_label", lambda s, d: selection.correlations(complete_profile(s, d), NUMBERS, "refund_value"), _numeric_sql("refund_value"), {"correlation": 6})
    add("select_binary_label", lambda s, d: selection.rank_test(complete_profile(s, d), NUMBERS, "refund_flag").select("feature", "h", (F.col("p_value") <= 0.05).alias("selected")), "SELECT feature, h, h >= 3.841458820694124 AS selected FROM tested", {"h": 3})
    add(
        "feature_selector",
        _selected,
        " UNION ALL ".join(f"SELECT '{label}' AS label, feature FROM ({_numeric_sql(label)}) WHERE abs(correlation) >= 0.1" for label in LABELS.numeric)
        + " UNION ALL SELECT 'refund_flag' AS label, feature FROM tested WHERE h >= 3.841458820694124",
    )

    # Splitting and sampling.
    add("split_ordered", lambda s, d: splitting.split_ordered(complete_profile(s, d).select(*IDS), ["transaction_date"], ["transaction_id"]), f"SELECT transaction_id, transaction_date, {_SPLIT.format(rows='filled')} AS train_test FROM filled", dates=day)
    add("split_hash", lambda s, d: splitting.split_hash(complete_profile(s, d).select(*IDS), ["transaction_id"]), f"SELECT transaction_id, transaction_date, CASE WHEN {_HASH.format(seed=0)} % 100 < 10 THEN 'test' ELSE 'train' END AS train_test FROM filled", dates=day)
    add("random_split", lambda s, d: splitting.split_random(complete_profile(s, d).select(*IDS), ["transaction_id"], seed=7), f"SELECT transaction_id, transaction_date, CASE WHEN round({_HASH.format(seed=7)} / 4294967296.0, 1) > 0.8 THEN 'test' ELSE 'train' END AS train_test FROM filled", dates=day)
    add("random_row_id", lambda s, d: hash_position(complete_profile(s, d).select("transaction_id"), ["transaction_id"], "row_id", seed=3), f"SELECT transaction_id, row_number() OVER (ORDER BY {_HASH.format(seed=3)}, transaction_id) AS row_id FROM filled")
    add("user_table_ml_ready", lambda s, d: splitting.tables_by_label(complete_profile(s, d), LABELS.all, ["transaction_id"])["refund_value"], f"SELECT * EXCLUDE (refund_proportion, refund_flag), CASE WHEN {_HASH.format(seed=0)} % 100 < 10 THEN 'test' ELSE 'train' END AS train_test FROM filled", dates=day)
    add("union_splits", lambda s, d: _split_rows(s, d).filter("train_test = 'train'").unionByName(_split_rows(s, d).filter("train_test = 'test'")).select(*IDS, SPLIT_COLUMN), f"SELECT transaction_id, transaction_date, train_test FROM ({_TAGGED})", dates=day)
    add("resampling_strategy", lambda s, d: resampling.class_counts(complete_profile(s, d), "refund_value", LabelType.NUMERICAL), "SELECT CASE WHEN refund_value > 0 THEN 1 ELSE 0 END AS label_class, count(*) AS row_count FROM filled GROUP BY 1")
    add("resample_text", lambda s, d: resampling.resample(complete_profile(s, d).filter("status <> 'open' OR rarely_set = 1"), "status", LabelType.CATEGORICAL, ["transaction_id"], strategy=resampling.Strategy.UNDER).groupBy("status").agg(F.count("*").alias("row_count")), """
        SELECT status, (SELECT min(n) FROM (SELECT count(*) AS n FROM filled WHERE status <> 'open' OR rarely_set = 1 GROUP BY status)) AS row_count
        FROM filled WHERE status <> 'open' OR rarely_set = 1 GROUP BY status""")
    add("resample", _resample(resampling.Strategy.UNDER), _RESAMPLE_UNDER, dates=day)
    add("resample_over", _resample(resampling.Strategy.OVER), _RESAMPLE_OVER, dates=day)

    # Encoding.
    keys = "transaction_id, transaction_date, train_test"
    add("min_max_scale", lambda s, d: _encode(s, d, _SCALED, []), _encoded_sql(_TAGGED, keys, _SCALED, []), _SCALED_DIGITS, day)
    add("one_hot", lambda s, d: _encode(s, d, [], STRINGS), _encoded_sql(_TAGGED, keys, [], STRINGS), {}, day)
    add("sparse_one_hot", _sparse, _SPARSE_SQL, {"value": 9}, day)
    add("preprocess_pipeline", lambda s, d: _encode(s, d, _SCALED, STRINGS), _encoded_sql(_TAGGED, keys, _SCALED, STRINGS), _SCALED_DIGITS, day)
    add("pipeline_roundtrip", lambda s, d: _encode(s, d, _SCALED, STRINGS, roundtrip=True), _encoded_sql(_TAGGED, keys, _SCALED, STRINGS), _SCALED_DIGITS, day)
    ready = f"(SELECT *, {_SPLIT.format(rows='cleaned')} AS train_test FROM cleaned)"
    add("ml_ready_data", lambda s, d: _training(s, d).tables["refund_value"], _CLEANED + _encoded_sql(f"SELECT * FROM {ready}", "transaction_id, transaction_date, refund_value, train_test", _SELECTED, STRINGS), _SELECTED_DIGITS, day)
    add("ml_ready_flags", lambda s, d: _training(s, d).tables["refund_flag"], _CLEANED + _encoded_sql(f"SELECT * FROM {ready}", "transaction_id, transaction_date, refund_flag, train_test", _SELECTED, STRINGS), _SELECTED_DIGITS, day)
    # New rows take the ranges of the training rows, and none is dropped.
    served = f"SELECT f.*, CASE WHEN r.train_test = 'train' THEN 'train' ELSE 'new' END AS train_test FROM filled f LEFT JOIN {ready} r USING (transaction_id)"
    add("preprocess_predict", lambda s, d: prepare_prediction(order_profile(s, d), _training(s, d).fitted)["refund_flag"], _CLEANED + _encoded_sql(served, "transaction_id, transaction_date, refund_flag", _SELECTED, STRINGS), _SELECTED_DIGITS, day)

    # Metrics over score tables.
    add("two_step_merge", lambda s, d: modeling.two_step_merge(*_two_step_inputs(s, d), gate_on_label=False, threshold=0.5), _two_step_sql("c.probability < 0.5"), dates=day)
    add("two_step_merge_label", lambda s, d: modeling.two_step_merge(*_two_step_inputs(s, d)), _two_step_sql("c.label = 0"), dates=day)
    add("regression_metrics", lambda s, d: evaluation.regression_metrics(scores(s, d)), f"SELECT count(*) AS n_observations, {_ERRORS}, 1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(*)) AS r2 FROM sc", {"rmse": 2, "mae": 2, "r2": 6})
    add(
        "classification_metrics",
        lambda s, d: evaluation.classification_metrics(scores(s, d)),
        """SELECT tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, (tp + tn) / n AS accuracy,
                  2 * tp / nullif(2 * tp + fp + fn, 0) AS f1_score, (rs - p * (p + 1) / 2) / (p * (n - p)) AS roc_auc
           FROM (SELECT count(*) AS n, count(CASE WHEN label = 1 THEN 1 END) AS p,
                        count(CASE WHEN probability >= 0.5 AND label = 1 THEN 1 END) AS tp, count(CASE WHEN probability >= 0.5 AND label <> 1 THEN 1 END) AS fp,
                        count(CASE WHEN probability < 0.5 AND label = 1 THEN 1 END) AS fn, count(CASE WHEN probability < 0.5 AND label <> 1 THEN 1 END) AS tn,
                        sum(CASE WHEN label = 1 THEN r END) AS rs
                 FROM (SELECT *, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS r FROM sc))""",
        {c: 9 for c in ["precision", "recall", "accuracy", "f1_score", "roc_auc"]},
    )
    add("spearman_by_split", lambda s, d: evaluation.rank_correlation(scores(s, d)), _SPEARMAN, {"spearman_rank_correlation_score": 6})
    add("split_metrics", lambda s, d: evaluation.split_metrics(scores(s, d)), f"SELECT m.*, s.spearman_rank_correlation_score FROM (SELECT train_test, count(*) AS n_observations, {_ERRORS} FROM sc GROUP BY 1) m LEFT JOIN ({_SPEARMAN}) s ON s.train_test = m.train_test", {"rmse": 2, "mae": 2, "spearman_rank_correlation_score": 6})
    add("tier_comparison", lambda s, d: evaluation.tier_comparison(scores(s, d), IDS), "SELECT train_test, tier, avg(actual) AS tier_level_avg_actual, avg(prediction) AS tier_level_avg_prediction FROM (SELECT *, ntile(10) OVER (PARTITION BY train_test ORDER BY prediction DESC, transaction_id, transaction_date) AS tier FROM sc) GROUP BY 1, 2", {"tier_level_avg_actual": 2, "tier_level_avg_prediction": 6})
    add("prediction_distribution", lambda s, d: evaluation.prediction_distribution(scores(s, d)), _describe_sql(["actual", "prediction"], "sc"), {"actual": 2, "prediction": 6})
    add("prediction_histogram", lambda s, d: evaluation.histogram(scores(s, d), "prediction", 0.0, 10.0, 5), "SELECT CASE WHEN prediction < 0 THEN 0 WHEN prediction >= 10 THEN 6 ELSE CAST(floor(prediction / 2) AS BIGINT) + 1 END AS bin, count(*) AS row_count FROM sc GROUP BY 1")
    add("adjusted_value", lambda s, d: evaluation.adjusted_value(scores(s, d)).select(*IDS, "adjusted_conversion_value"), "SELECT transaction_id, transaction_date, transaction_value - prediction AS adjusted_conversion_value FROM sc", dates=day)
    add("top_features", lambda s, d: evaluation.top_features(selection.correlations(complete_profile(s, d), NUMBERS, "refund_value").select("feature", F.abs("correlation").alias("attribution")), 3), f"SELECT feature, abs(correlation) AS attribution FROM ({_numeric_sql('refund_value')}) ORDER BY attribution DESC NULLS LAST, feature LIMIT 3", {"attribution": 6})

    # Model jobs; fitted numbers have no SQL counterpart.
    add("train_linear", _regression_scores(ModelFamily.LINEAR_REGRESSION), None)
    add("train_logistic", _classifier_metrics(ModelFamily.LOGISTIC_REGRESSION), None)
    add("train_gbt", _regression_scores(ModelFamily.BOOSTED_TREE_REGRESSOR), None)
    add("train_mlp", _classifier_metrics(ModelFamily.NEURAL_CLASSIFIER), None)
    add("train_one_step", lambda s, d: train_one_step(_training(s, d).tables["refund_value"], "refund_value", space=modeling.SearchSpace()).tiers, None)
    add("train_two_step", lambda s, d: _two_steps(s, d, lambda r, t: r.split_metrics), None)
    add("score_regression", lambda s, d: (lambda m: modeling.score_regression(m[0].pipeline, m[1], "refund_value"))(_fit("refund_value", ModelFamily.LINEAR_REGRESSION)(s, d)), None)
    add("score_classifier", lambda s, d: (lambda m: modeling.score_classifier(m[0].pipeline, m[1]))(_fit("refund_flag", ModelFamily.LOGISTIC_REGRESSION)(s, d)), None)
    trial = ["trial_id", "validation_metric", "rounds", "status", "is_optimal"]
    add("trial_log", lambda s, d: _trial_log(s, d).select(*trial), _TRIALS_SQL, {"validation_metric": -1})
    add("best_trial", lambda s, d: modeling.best_trial(_trial_log(s, d)).select(*trial), f"SELECT * FROM ({_TRIALS_SQL}) WHERE is_optimal ORDER BY trial_id LIMIT 1", {"validation_metric": -1})
    add("stream_scores", _streamed, f"SELECT transaction_id, transaction_date, prediction FROM ({_LINE_SQL})", {"prediction": -2}, day)
    add("train_line", _line, _LINE_SQL, {"prediction": -2}, day)
    add("train_gbt_classifier", _classifier_metrics(ModelFamily.BOOSTED_TREE_CLASSIFIER), None)
    add("models_beat_mean", _families, " UNION ALL ".join(f"SELECT '{f.value}' AS family, true AS beats_mean, 10 AS trials" for f in _FAMILIES))
    add("permutation_importance", _importances, " UNION ALL ".join(f"SELECT '{f.value}' AS family, true AS planted_first, true AS noise_far_below" for f in _FAMILIES))
    add("feature_importance", lambda s, d: (lambda m: evaluation.top_features(modeling.feature_importance(m[0], m[1])))(_fit("refund_value", ModelFamily.BOOSTED_TREE_REGRESSOR)(s, d)), None)
    add("predict_two_step", _predicted, None)
    return q


__all__ = ["queries"]
