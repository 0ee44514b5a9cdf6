"""A registered query: the Spark job, and the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.sql import BLOCKS, SHOP, WEB, statement
from returnscope.config import RunWindow
from returnscope.operators.lookups import Lookups
from returnscope.sources.bindings import shop_frames, web_frames
from returnscope.sources.export import EventFrames
from returnscope.sources.tables import no_stage, stage

SHOP_WINDOW = RunWindow(dt.date(1995, 1, 1), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
WEB_WINDOW = RunWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
# A prediction run: features for the latest transactions, history from everything before.
SHOP_RECENT = RunWindow(dt.date(2001, 1, 1), dt.date(2001, 6, 1), dt.date(2001, 7, 25))
WEB_RECENT = RunWindow(dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 1, 27))


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


@dataclass(frozen=True)
class Source:
    frames: Callable[[SparkSession, str], EventFrames]
    window: RunWindow
    blocks: dict[str, str]


SOURCES = {
    "shop": Source(shop_frames, SHOP_WINDOW, SHOP),
    "web": Source(web_frames, WEB_WINDOW, WEB),
    "shop_recent": Source(shop_frames, SHOP_RECENT, SHOP),
    "web_recent": Source(web_frames, WEB_RECENT, WEB),
}


def comparable(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Dates as text, timestamps as microseconds, and rounding of quotients."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        if f.name in digits:
            c = F.round(c, digits[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


def comparable_sql(body: str, digits: dict[str, int], dates: Sequence[str]) -> str:
    changes = [f"CAST({d} AS VARCHAR) AS {d}" for d in dates] + [f"round({c}, {n}) AS {c}" for c, n in digits.items()]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({body})" if changes else body


def event_query(
    source: str,
    build: Callable[[EventFrames, Lookups], DataFrame],
    body: str,
    digits: dict[str, int] | None = None,
    dates: Sequence[str] = ("transaction_date",),
    staged: bool = False,
) -> Query:
    """Query over the flat event frames of a source.

    ``staged`` writes the frames and key sets that the job uses once, as a feature run does; worth
    it for jobs that read them several times.
    """
    src, digits = SOURCES[source], digits or {}

    def run(spark: SparkSession, directory: str) -> DataFrame:
        frames = src.frames(spark, directory)
        if staged:
            frames = frames.kept(stage)
        return comparable(build(frames, Lookups(frames, src.window, stage if staged else no_stage)), digits)

    sql = statement(comparable_sql(body, digits, dates), {**src.blocks, **BLOCKS})
    for name, day in (("start", src.window.start), ("tstart", src.window.transaction_start), ("end", src.window.end)):
        sql = sql.replace("{" + name + "}", day.isoformat())
    return Query(run, sql)


def table_query(
    build: Callable[[SparkSession, str], DataFrame],
    body: str | None,
    digits: dict[str, int] | None = None,
    dates: Sequence[str] = (),
    blocks: dict[str, str] | None = None,
) -> Query:
    """Query over the plain tables."""
    digits = digits or {}

    def run(spark: SparkSession, directory: str) -> DataFrame:
        return comparable(build(spark, directory), digits)

    return Query(run, None if body is None else statement(comparable_sql(body, digits, dates), blocks or {}))
