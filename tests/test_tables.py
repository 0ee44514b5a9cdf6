"""Tables that are replaced, extended and dropped with their files."""

from threading import Barrier

import pytest
from pyspark.sql import functions as F

from returnscope.sources import tables


@pytest.fixture
def name(spark):
    tables.drop_tables(spark, ["replaceable"])
    yield "replaceable"
    tables.drop_tables(spark, ["replaceable"])


def values(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


@pytest.mark.parametrize("with_path", [False, True])
def test_a_table_is_replaced_by_rows_of_its_own(spark, name, tmp_path, with_path):
    path = str(tmp_path) if with_path else None
    tables.write_table(spark.range(5), name, path=path)
    old = tables.table_location(spark, name)
    tables.write_table(spark.table(name).filter("id > 2"), name, path=path)
    assert values(spark, name) == [3, 4]
    assert not tables.path_exists(spark, old)
    tables.write_table(spark.range(1), name, append=True)
    assert values(spark, name) == [0, 3, 4]


def test_a_failed_write_leaves_the_old_table(spark, name):
    tables.write_table(spark.range(3), name)
    place = tables.table_location(spark, name)
    with pytest.raises(Exception, match="on purpose"):
        tables.write_table(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("on purpose")).cast("long")).alias("id")), name)
    assert values(spark, name) == [0, 1, 2] and tables.table_location(spark, name) == place


def test_a_replacement_may_change_the_columns(spark, name):
    tables.write_table(spark.range(3), name)
    tables.write_table(spark.range(2).select(F.lit("x").alias("other"), "id"), name)
    assert spark.table(name).columns == ["other", "id"] and spark.table(name).count() == 2


def test_dropped_tables_leave_no_files(spark, name, tmp_path):
    tables.write_table(spark.range(3), name, path=str(tmp_path))
    tables.write_table(spark.range(3), "replaceable_kept")
    place, kept = tables.table_location(spark, name), tables.table_location(spark, "replaceable_kept")
    assert tables.drop_tables(spark, [name, "replaceable_kept", "never_there"], keep=["replaceable_kept"]) == [name]
    assert not tables.path_exists(spark, place) and tables.path_exists(spark, kept)
    assert tables.drop_tables(spark, ["replaceable_kept"]) == ["replaceable_kept"] and not tables.path_exists(spark, kept)


def test_bucketed_tables(spark, name):
    tables.write_table(spark.range(20), name, bucket_by=["id"], buckets=4)
    tables.write_table(spark.range(10), name, bucket_by=["id"], buckets=4)
    assert values(spark, name) == list(range(10))
    assert "Num Buckets" in {r[0] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def test_what_a_run_stages_goes_with_it(spark):
    before = tables.stage(spark.range(2), "before")
    with pytest.raises(RuntimeError), tables.staging(spark):
        tables.stage(spark.range(3), "inside")
        inside = [p for p in tables.staged_paths(spark) if "/inside-" in p][-1]
        raise RuntimeError
    assert not tables.path_exists(spark, inside) and before.count() == 2


def test_steps_run_side_by_side(spark):
    """Four meet each other, results come in the order of the steps, and staging leaves the session's setting as it was."""
    met = Barrier(4, timeout=30)

    def step(n):
        met.wait()
        return tables.stage(spark.range(n).groupBy("id").count(), f"step{n}").count()

    spark.conf.unset(tables.CLEANUP_CONF)
    earlier = spark.conf.get(tables.CLEANUP_CONF, None)
    before = set(tables.staged_paths(spark))
    assert tables.side_by_side([lambda n=n: step(n) for n in (5, 3, 4, 2)]) == [5, 3, 4, 2]
    assert spark.conf.get(tables.CLEANUP_CONF, None) == earlier
    assert len(tables.release_staged(spark, [p for p in tables.staged_paths(spark) if p not in before])) == 4


def test_a_failing_step_is_raised_when_the_others_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("no luck")

    with pytest.raises(ValueError, match="no luck"):
        tables.side_by_side([fails, lambda: ended.append(spark.range(3).count())])
    assert ended == [3]
