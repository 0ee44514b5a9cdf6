"""Small vectors with known results for cleaning, selection, splitting, resampling and encoding."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from returnscope.config import LabelType, Labels
from returnscope.operators import cleaning, modeling, resampling, selection, splitting
from returnscope.operators.encoding import Encoder
from returnscope.operators.resampling import Strategy, choose
from returnscope.plans.preprocess import FittedPreprocessing, prepare_prediction, prepare_training
from returnscope.sources.columns import clean_column_names

IDS = ["transaction_id", "transaction_date"]
LABELS = Labels(("refund_value", "refund_proportion"), ("refund_flag",))
COLUMNS = (
    "transaction_id, transaction_date, transaction_value, refund_value, refund_flag, refund_proportion, shipping_value, item_count,"
    " min_price, max_price, event_count_click, event_count_first_visit, event_count_purchase"
).split(", ")
def _row(i):
    """One of twelve rows with scattered values, one a day."""
    return (
        f"t{i:02d}", f"2024-03-{i + 1:02d}", 30.0 + 11 * (7 * i % 12), 2 + 1.5 * ((5 * i + 3) % 12), float(7 * i % 12 > 6), i * i % 7 / 10,
        1.0 + 3 * i % 5, 1.0 + i % 4, 5.0 + i * i % 11, 40.0 + i**3 % 13, 3.0 + 5 * i % 9, 1.0 + i % 2, 1.0 + 7 * i % 3,
    )


ROWS = [_row(i) for i in range(12)]


def values(column):
    return np.array([r[COLUMNS.index(column)] for r in ROWS])


def following(label, least=0.1):
    """Numeric features whose correlation with the label is large enough, none of them a close call."""
    found = {c: abs(np.corrcoef(values(c), values(label))[0, 1]) for c in COLUMNS[2:] if c not in LABELS.all}
    assert all(abs(r - least) > 1e-3 for r in found.values())
    return [c for c, r in found.items() if r > least]


@pytest.fixture(scope="module")
def twelve(spark):
    schema = ", ".join(f"{c} {'double' if c not in IDS else 'string'}" for c in COLUMNS)
    return spark.createDataFrame(ROWS, schema).withColumn("transaction_date", F.to_date("transaction_date"))


def test_invalid_columns_and_rows(spark):
    rows = [("p", 1.0, 0.0, None), ("q", 2.0, 0.0, "unknown"), ("r", 0.0, 3.0, "x"), ("s", 4.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id string, a double, b double, s string")
    assert set(cleaning.invalid_columns(df, 0.5)) == {"b", "s"}
    assert {r.id for r in df.filter(cleaning.row_invalid_share(df) > 0.3).collect()} == {"p", "q", "s"}


def test_row_and_column_removal(spark):
    rows = [("1", 1.0, 0.0, 1.0, 1.0), ("2", 2.0, 0.0, 1.0, 1.0), ("3", 0.0, 0.0, 0.0, None), ("4", 4.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, f double, g double, a double, b double")
    kept = cleaning.drop_invalid_rows_and_columns(df, ["id"], ["a", "b"], 0.2, 0.2)
    assert kept.columns == ["id", "a", "b"] and {r.id for r in kept.collect()} == {"1", "2", "4"}


def test_coercion_and_imputation(spark):
    df = spark.createDataFrame([("2024-02-30", 1, None), ("2024-02-28", None, "x")], "d string, n int, s string")
    kinds = cleaning.ColumnKinds(["d"], ["s"], ["n"])
    done = cleaning.impute(cleaning.coerce_types(df, kinds))
    assert done.dtypes == [("d", "date"), ("n", "double"), ("s", "string")]
    assert [(str(r.d), r.n, r.s) for r in done.collect()] == [("None", 1.0, "unknown"), ("2024-02-28", 0.0, "x")]


def test_describe_interpolates(spark):
    df = spark.createDataFrame([(8.0, 1.0), (2.0, 9.0), (32.0, 5.0), (4.0, 3.0), (16.0, 7.0)], "x double, y double")
    got = {r.statistic: (r.x, r.y) for r in cleaning.describe(df, ["x", "y"]).collect()}
    assert got["count"] == (5.0, 5.0) and got["50%"] == (8.0, 5.0) and got["25%"] == (4.0, 3.0)
    four = {r.statistic: r.x for r in cleaning.describe(df.filter("x > 2"), ["x"]).collect()}
    assert four["25%"] == pytest.approx(7.0) and four["75%"] == pytest.approx(20.0)


def test_pearson_filter(twelve):
    numbers, _ = cleaning.feature_columns(twelve, IDS, LABELS.all)
    for label in LABELS.numeric:
        for least in (0.1, 0.2):
            assert selection.correlated_features(twelve, numbers, label, least) == following(label, least)


def test_rank_test(spark):
    rows = list(zip([1.0, 1, 2, 3, 5, 6, 6, 8], [4.0, 1, 3, 2, 2, 3, 1, 4], [0] * 4 + [1] * 4, [0, 1] * 4, [3.0] * 8))
    rows = [(float(a), float(b), *rest) for a, b, *rest in rows]
    df = spark.createDataFrame(rows, "f1 double, f2 double, y int, y2 int, same double")
    got = {r.feature: (r.h, r.p_value) for r in selection.rank_test(df, ["f1", "f2", "same"], "y").collect()}
    # Rank sums 10 and 26 of eight rows; two pairs of ties.
    h = (12 / 72 * (10**2 / 4 + 26**2 / 4) - 27) / (1 - 12 / 504)
    assert got["f1"] == (pytest.approx(h), pytest.approx(math.erfc(math.sqrt(h / 2))))
    assert got["f2"] == (pytest.approx(0.0, abs=1e-9), pytest.approx(1.0, abs=1e-4))
    assert got["same"][0] is None
    assert selection.discriminating_features(df, ["f1", "f2", "same"], "y") == ["f1"]
    assert selection.discriminating_features(df, ["f1", "f2"], "y2") == []


def test_selector(spark):
    # u follows the amount; v does not.
    rows = [(11, 3, 0, 7.0, 11, "m"), (12, 9, 1, 19.0, 12, "n"), (13, 4, 1, 9.0, 10, "n"), (14, 12, 0, 25.0, 10, "m"), (15, 7, 1, 15.0, 7, "k")]
    df = spark.createDataFrame(rows, "id long, amount int, late int, u double, v int, note string")
    fitted = selection.FeatureSelector.fit(df, ["id"], Labels(("amount",), ("late",)), 0.5)
    assert fitted.columns == {"amount": ["u", "amount", "id", "note"], "late": ["late", "id", "note"]}
    with pytest.raises(ValueError, match="missing"):
        fitted.transform(df.drop("u"))


def test_split_sizes_and_order(spark):
    df = spark.createDataFrame([(i, f"2024-01-{1 + i // 3:02d}") for i in range(10)], "id long, day string")
    tags = {r.id: r.train_test for r in splitting.split_ordered(df, ["day"], ["id"], 0.4).collect()}
    assert {i for i, t in tags.items() if t == "test"} == {6, 7, 8, 9}
    early = {r.id for r in splitting.split_ordered(df, ["day"], ["id"], 0.4, latest=False).filter("train_test = 'test'").collect()}
    assert early == {0, 1, 2, 3}
    assert splitting.number_of_test_rows(5, 0.1) == 1 and splitting.number_of_test_rows(200_000, 0.3) == 60_000
    assert splitting.number_of_test_rows(200_000, 0.3, 500) == 500 and splitting.number_of_test_rows(4, 0.3, 500) == 3


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "transaction_id")
    one = {r[0] for r in splitting.split_hash(df, ["transaction_id"]).filter("train_test = 'test'").select("transaction_id").collect()}
    two = {r[0] for r in splitting.split_hash(df.repartition(7), ["transaction_id"]).filter("train_test = 'test'").select("transaction_id").collect()}
    assert one == two and 400 < len(one) < 600


def test_resampling(spark):
    for wanted in (Strategy.OVER, Strategy.UNDER):
        assert choose({0: 3}, wanted) is Strategy.NONE and choose({0: 5, 1: 5}, wanted) is Strategy.NONE
        assert choose({0: 6, 1: 1}, wanted) is wanted and choose({0: 50_000, 1: 50}, wanted) is wanted
    df = spark.range(700).select("id", F.when(F.col("id") < 60, 1.5).otherwise(0.0).alias("y"))
    over = resampling.resample(df, "y", LabelType.NUMERICAL, ["id"], Strategy.OVER)
    assert {r[0]: r[1] for r in resampling.class_counts(over, "y", LabelType.NUMERICAL).collect()} == {0: 640, 1: 640}
    assert over.filter("y > 0").groupBy("id").count().agg(F.min("count"), F.max("count")).first()[:] == (10, 11)
    under = resampling.resample(df, "y", LabelType.NUMERICAL, ["id"], strategy=Strategy.UNDER)
    assert under.count() == 120 and under.filter("y > 0").count() == 60


def test_encoder(spark):
    train = spark.createDataFrame([("red", 10.0, 1.0), ("blue", 20.0, 1.0), ("green", 30.0, 1.0)], "colour string, price double, same double")
    encoder = Encoder.from_json(Encoder.fit(train, ["price", "same"], ["colour"]).to_json())
    new = spark.createDataFrame([("black", 40.0, 1.0)], train.schema)
    row = encoder.transform(new, []).first().asDict()
    assert row == {"cat_colour_blue": 0.0, "cat_colour_green": 0.0, "cat_colour_red": 0.0, "num_price": 1.5, "num_same": 0.0}
    with pytest.raises(ValueError, match="distinct values"):
        Encoder.fit(train, [], ["colour"], limit=2)
    with pytest.raises(ValueError, match="at least one"):
        Encoder.fit(train, [], [])
    with pytest.raises(ValueError, match="collide"):
        Encoder.fit(spark.createDataFrame([("A-B",), ("A B",)], "c string"), [], ["c"])
    with pytest.raises(ValueError, match="collide"):
        clean_column_names(spark.sql("select 1 as `a b`, 2 as `a-b`"))


def test_training_end_to_end(spark, twelve, tmp_path):
    data = prepare_training(twelve, IDS, LABELS)
    assert list(data.tables) == LABELS.all
    table = data.tables["refund_value"]
    rows = table.orderBy("transaction_date").collect()
    assert [r.train_test for r in rows] == ["train"] * 11 + ["test"]
    names = following("refund_value")
    assert names and set(table.columns) == {*IDS, "refund_value", "train_test", *[f"num_{n}" for n in names]}
    scaled = {n: (values(n) - values(n)[:11].min()) / np.ptp(values(n)[:11]) for n in names}
    for n in names:
        assert [r[f"num_{n}"] for r in rows] == pytest.approx(scaled[n].tolist())

    data.fitted.save(spark, str(tmp_path / "fitted"))
    loaded = FittedPreprocessing.load(spark, str(tmp_path / "fitted"))
    assert loaded == data.fitted
    again = prepare_prediction(twelve, loaded)["refund_value"].orderBy("transaction_date").collect()
    assert [r[f"num_{names[0]}"] for r in again] == pytest.approx(scaled[names[0]].tolist())


def test_constant_label_is_refused(spark, twelve):
    with pytest.raises(ValueError, match="single value"):
        cleaning.drop_constant_columns(twelve.withColumn("refund_flag", F.lit(1.0)), IDS, LABELS.all)
    kept = cleaning.drop_constant_columns(twelve.withColumn("transaction_id", F.lit("1")).withColumn("x", F.lit(2.0)), IDS, LABELS.all)
    assert "transaction_id" in kept.columns and "x" not in kept.columns


def test_wide_rows_are_cleaned(spark):
    wide = spark.range(3).select("id", *[F.when(F.col("id") > i % 3, 1.0).alias(f"c{i}") for i in range(900)])
    # Of 900 columns, row 1 has a value in a third, row 2 in two thirds.
    assert [r["id"] for r in cleaning.drop_invalid_rows(wide, 0.5).select("id").collect()] == [2]


def test_tied_classes_keep_their_transaction(spark):
    class Fitted:
        def transform(self, df):
            return df.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))

    rows = spark.createDataFrame([("a", "2024-01-01", 0.5), ("b", "2024-01-01", 0.25), ("c", "2024-01-01", 0.75)], "transaction_id string, transaction_date string, p double")
    scored = modeling.score_classifier(Fitted(), rows).select("transaction_id", "label").collect()
    assert sorted(map(tuple, scored)) == [("a", 1), ("b", 0), ("c", 1)]


def test_sums_of_many_columns_are_one_compiled_aggregate(spark):
    """A column with only nulls, a constant one, and rows whose value is missing; the plan doesn't grow with the columns."""
    wide = spark.range(40).select(
        (F.col("id") % 7).cast("double").alias("y"),
        F.when(F.col("id") % 3 != 0, F.col("id") * 2.0).alias("gaps"),
        F.lit(None).cast("double").alias("none"),
        F.lit(4.0).alias("same"),
        *[(F.col("id") * i % 11).cast("double").alias(f"f{i}") for i in range(60)],
    )
    features = wide.columns[1:]
    for found, call in ((selection.correlations(wide, features, "y"), "covar_pop("), (cleaning.column_invalid_shares(wide), "sum(")):
        assert found._jdf.queryExecution().analyzed().toString().count(call) == 1
    rates = {r["feature"]: r["correlation"] for r in selection.correlations(wide, features, "y").collect()}
    ids = np.array([i for i in range(40) if i % 3])
    assert list(rates) == features
    assert rates["gaps"] == pytest.approx(np.corrcoef(ids * 2.0, ids % 7)[0, 1])
    assert rates["none"] is None and rates["same"] is None
    assert [c for c in cleaning.constant_columns(wide) if not c.startswith("f")] == ["same"]
    assert cleaning.number_ranges(wide, ["gaps", "none"]) == {"gaps": (2.0, 76.0), "none": (None, None)}
    empty = selection.correlations(wide.limit(0), features, "y").collect()
    assert [r["feature"] for r in empty] == features and not any(r["correlation"] for r in empty)
