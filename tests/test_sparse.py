"""Dictionaries and sparse rows for any number of values."""

import pytest
from pyspark.sql import functions as F

from returnscope.operators import features
from returnscope.operators.encoding import Encoder
from returnscope.operators.sparse import SparseEncoder, as_vectors, dictionary, unfolded
from returnscope.sources.tables import bounded_levels

EVENTS = "transaction_id string, transaction_date date, event_name string, event_length_in_seconds double, event_count long"


def test_a_dictionary_counts_up_in_name_order(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "x"), ("b", "x"), (None, "x")], "column string, level string")
    rows = dictionary(df, ["column", "level"], first=3).collect()
    assert sorted((r["position"], r["column"], r["level"]) for r in rows) == [(3, "a", "x"), (4, "a", "y"), (5, "b", "x")]
    assert dictionary(df.limit(0), ["column", "level"]).count() == 0


def test_events_of_a_hundred_thousand_names(spark):
    """Every name once, one of them in every transaction: no cap, no column each."""
    day = F.lit("2024-01-01").cast("date")
    rare = spark.range(100_000).select(F.col("id") % 500, F.concat(F.lit("event "), "id"), F.col("id") * 0.5, F.col("id") + 1)
    common = spark.range(500).select("id", F.lit("common"), F.lit(1.0), F.lit(7).cast("long"))
    observed = rare.union(common).toDF("t", "event_name", "event_length_in_seconds", "event_count")
    observed = observed.select(F.col("t").cast("string").alias("transaction_id"), day.alias("transaction_date"), "event_name", "event_length_in_seconds", "event_count")
    names = features.event_dictionary(observed)
    rows = features.sparse_events(observed, names)
    assert names.count() == 100_001
    assert rows.agg(F.min(F.size("event_positions")), F.max(F.size("event_count")), F.count("*")).first()[:] == (201, 201, 500)
    assert rows.filter(F.array_sort("event_positions") != F.col("event_positions")).count() == 0
    back = unfolded(rows, names, ["transaction_id", "transaction_date"], "event_positions", features.EVENT_MEASURES)
    assert back.select(*observed.columns).exceptAll(observed).count() == 0 and back.count() == observed.count()


def test_unknown_names_and_transactions_without_events(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    rows = [("1", day, "view", 2.0, 3), ("1", day, "new", 2.0, 3), ("2", day, "new", 1.0, 1), ("3", day, None, None, None), ("4", day, "view", None, None)]
    observed = spark.createDataFrame(rows, EVENTS)
    names = spark.createDataFrame([("view", 0)], "event_name string, position long")
    got = {r["transaction_id"]: (r["event_positions"], r["event_count"], r["event_length_in_seconds"]) for r in features.sparse_events(observed, names).collect()}
    assert got == {"1": ([0], [3], [2.0]), "2": ([], [], []), "3": ([], [], []), "4": ([], [], [])}


ROWS = [(1, 0.0, "x", "p"), (2, 5.0, "y", None), (3, 10.0, "x", "q"), (4, None, None, None)]


def test_sparse_rows_equal_dense_ones(spark, tmp_path):
    train = spark.createDataFrame(ROWS, "id long, n double, a string, b string")
    fitted = SparseEncoder.fit(train, ["n"], ["a", "b"])
    fitted.save(spark, str(tmp_path))
    encoder = SparseEncoder.load(spark, str(tmp_path))
    assert (encoder.size, encoder.ranges, encoder.categorical) == (5, {"n": (0.0, 10.0)}, ["a", "b"])
    dense = {r["id"]: list(r[1:]) for r in Encoder.fit(train, ["n"], ["a", "b"]).transform(train.fillna({"n": 0.0}), ["id"]).collect()}
    # The dense form has levels first.
    order = [4, 0, 1, 2, 3]
    for r in encoder.transform(train, ["id"]).collect():
        row = [0.0] * encoder.size
        for position, value in zip(r["positions"], r["values"], strict=True):
            row[position] = value
        assert row == [dense[r["id"]][k] for k in order]


def test_unseen_levels_have_no_position(spark):
    train = spark.createDataFrame(ROWS, "id long, n double, a string, b string")
    new = spark.createDataFrame([(9, 20.0, "unseen", "p")], train.schema)
    encoder = SparseEncoder.fit(train, ["n"], ["a", "b"])
    row = encoder.transform(new.withColumn("split", F.lit("test")), ["id"], ["split"]).first()
    assert (row["split"], row["positions"], row["values"]) == ("test", [0, 3], [2.0, 1.0])
    assert as_vectors(encoder.transform(new, ["id"]), encoder.size).first()["features"].toArray().tolist() == [2.0, 0.0, 0.0, 1.0, 0.0]
    with pytest.raises(ValueError, match="missing"):
        encoder.transform(new.drop("a"), ["id"])


@pytest.mark.parametrize(("numeric", "categorical", "size"), [(["n"], [], 1), ([], ["a"], 2)])
def test_either_kind_alone(spark, numeric, categorical, size):
    train = spark.createDataFrame(ROWS, "id long, n double, a string, b string")
    encoder = SparseEncoder.fit(train, numeric, categorical)
    assert encoder.size == size and encoder.transform(train, ["id"]).count() == 4
    with pytest.raises(ValueError, match="at least one"):
        SparseEncoder.fit(train, [], [])


def test_twenty_thousand_levels(spark):
    rows = spark.range(40_000).select("id", (F.col("id") % 20_000).cast("string").alias("a"), F.lit("same").alias("b"))
    encoder = SparseEncoder.fit(rows, [], ["a", "b"])
    assert encoder.size == 20_001
    encoded = encoder.transform(rows, ["id"])
    assert encoded.agg(F.count_distinct("positions"), F.min(F.size("positions")), F.max(F.element_at("positions", -1))).first()[:] == (20_000, 2, 20_000)


def test_levels_for_columns_are_read_at_once_and_bounded(spark):
    df = spark.createDataFrame(ROWS, "id long, n double, a string, b string")
    assert bounded_levels(df, ["a", "b"], 2) == {"a": ["x", "y"], "b": ["p", "q"]}
    assert bounded_levels(df, [], 2) == {}
    with pytest.raises(ValueError, match="more than 1"):
        bounded_levels(df, ["a", "b"], 1)
