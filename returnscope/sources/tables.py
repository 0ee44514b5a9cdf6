"""Tables: read, write, existence, clean-up, and staging of reused intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Independent steps that run side by side. Small ones are planned on the driver meanwhile, and fill each other's idle tasks.
SIDE_BY_SIDE = 4
_staged: dict[str, list[str]] = {}
_cleaning_up: dict[str, tuple[int, str | None]] = {}
_lock = Lock()


def read_table(spark: SparkSession, name: str, limit: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Table by name; with a limit, ``order_by`` makes the chosen rows reproducible."""
    return limited(spark.table(name), limit, order_by)


def limited(df: DataFrame, limit: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    if order_by:
        df = df.orderBy(*order_by)
    return df if not limit else df.limit(limit)


def table_location(spark: SparkSession, name: str) -> str:
    """Folder that holds a table's files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def write_table(
    df: DataFrame, name: str, append: bool = False, bucket_by: Sequence[str] = (), buckets: int = 0, path: str | None = None
) -> None:
    """Replace (default) or extend a table; bucketing keeps later key joins free of a shuffle.

    A replacement is written to a fresh folder under ``path`` (the shared folder by default) before the
    table is pointed at it, and the old files go last. A write that fails thus leaves the old table as it
    was, and the new rows may be derived from the old ones. Bucketed tables are replaced by Spark itself.
    """
    spark = df.sparkSession
    if bucket_by and buckets:
        mode = "append" if append else "overwrite"
        writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return
    if append and table_exists(spark, name):
        df.select(*spark.table(name).columns).write.mode("append").format("parquet").insertInto(name)
        return
    fresh = f"{path or stage_path(spark, name)}/v-{uuid.uuid4().hex[:12]}"
    try:
        df.write.mode("errorifexists").parquet(fresh)
    except Exception:
        delete_path(spark, fresh)
        raise
    old = None
    if table_exists(spark, name):
        old = table_location(spark, name)
        same = spark.table(name).schema.simpleString() == df.schema.simpleString()
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")
    if old is None or not same:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{fresh}'")
    if old is not None:
        delete_path(spark, old)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_tables(spark: SparkSession, names: Iterable[str], keep: Iterable[str] = ()) -> list[str]:
    """Drop the named tables if present, with their files, except those in ``keep``; returns what was dropped.

    The training run keeps its event table, which serves as the vocabulary of later predictions.
    """
    kept = set(keep)
    dropped = []
    for name in names:
        if name not in kept and table_exists(spark, name):
            location = table_location(spark, name)
            spark.sql(f"DROP TABLE {name}")
            # An external table's files stay behind otherwise.
            delete_path(spark, location)
            dropped.append(name)
    return dropped


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Text with a header line, by schema, so that no pass over the file looks for types; ``n/a`` is missing."""
    return spark.read.csv(path, header=True, schema=schema, nullValue="n/a", dateFormat=date_format)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for staged data: the session's ``spark.checkpoint.dir``.

    Where it is unset, a folder in the warehouse, which all executors share as well.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for this application in the shared folder."""
    return f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once and read it back.

    Cuts lineage at a node that several consumers read: the written columns survive the loss of
    executors, and each consumer prunes them to what it needs. The shuffle files behind it are
    removed as soon as it is written, since nothing reads them again. Files are packed by zstd, which
    takes less room than the default.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with _shuffles_removed(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with their query; the session's own setting is back once no thread needs this any more."""
    app = spark.sparkContext.applicationId
    with _lock:
        users, earlier = _cleaning_up.get(app, (0, None))
        if not users:
            earlier = spark.conf.get(CLEANUP_CONF, None)
            spark.conf.set(CLEANUP_CONF, "true")
        _cleaning_up[app] = (users + 1, earlier)
    try:
        yield
    finally:
        with _lock:
            users, earlier = _cleaning_up.pop(app)
            if users > 1:
                _cleaning_up[app] = (users - 1, earlier)
            elif earlier is None:
                spark.conf.unset(CLEANUP_CONF)
            else:
                spark.conf.set(CLEANUP_CONF, earlier)


def side_by_side(steps: Sequence[Callable[[], object]]) -> list:
    """What the steps return, in their order; a few of them run at a time, each in a thread of its own.

    For steps that don't need each other. All have ended when this returns; the first failure in their order is raised then.
    """
    if len(steps) < 2:
        return [step() for step in steps]
    threaded = inheritable_thread_target(SparkSession.builder.getOrCreate())
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        running = [pool.submit(threaded(step)) for step in steps]
    return [r.result() for r in running]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def staged_paths(spark: SparkSession) -> list[str]:
    """What this application has staged and not yet released, oldest first."""
    return list(_staged.get(spark.sparkContext.applicationId, []))


def release_staged(spark: SparkSession, paths: Iterable[str] | None = None) -> list[str]:
    """Delete staged data (all of it by default) once nothing reads it any more; returns what went."""
    known = _staged.get(spark.sparkContext.applicationId, [])
    gone = [p for p in (list(known) if paths is None else paths) if p in known]
    for path in gone:
        delete_path(spark, path)
        known.remove(path)
    return gone


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside is deleted at the end, also after a failure; for runs that write their results to tables."""
    before = set(staged_paths(spark))
    try:
        yield
    finally:
        release_staged(spark, [p for p in staged_paths(spark) if p not in before])


def no_stage(df: DataFrame, name: str) -> DataFrame:
    """Stand-in for :func:`stage` that keeps everything in one lazy plan."""
    return df


def bounded_values(df: DataFrame, column: str, limit: int) -> list:
    """Sorted distinct values of a column whose number is known to be small.

    Reads at most ``limit + 1`` values and refuses to go on beyond the limit, so neither a wrong
    assumption about the data nor a truncated list can pass unnoticed.
    """
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column} has more than {limit} distinct values")
    return sorted(r[0] for r in rows)


def bounded_levels(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, list]:
    """:func:`bounded_values` of several columns, read in one job."""
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in columns])
    rows = df.select(F.inline(pairs)).filter(F.col("level").isNotNull()).distinct().limit(limit * len(columns) + 1).collect()
    levels = {c: sorted(r["level"] for r in rows if r["name"] == c) for c in columns}
    for c, values in levels.items():
        if len(values) > limit or len(rows) > limit * len(columns):
            raise ValueError(f"column {c} has more than {limit} distinct values")
    return levels


def save_text(spark: SparkSession, text: str, path: str) -> None:
    """Small state as a one-row file next to the model, on whatever file system the path names."""
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0].rstrip("\n")
