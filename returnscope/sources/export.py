"""Reading the nested event export and flattening it into two narrow frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.functions.params import param_int, param_string
from returnscope.sources.schema import ECOMMERCE_FIELDS, EVENT_SCHEMA, ITEM_FIELDS


class EventFrames:
    """Flat view of the events: one row per event, and one row per item of an event.

    Both carry ``event_day`` (DATE) and the columns needed to judge whether the event is a valid
    transaction. Every operator projects the few columns it uses, so a columnar source is read
    column by column.
    """

    def __init__(self, events: Callable[[], DataFrame], items: Callable[[], DataFrame]) -> None:
        self._events, self._items = events, items

    @cached_property
    def events(self) -> DataFrame:
        return self._events()

    @cached_property
    def items(self) -> DataFrame:
        return self._items()

    def kept(self, keep: Callable[[DataFrame, str], DataFrame]) -> EventFrames:
        """Frames that pass through ``keep`` when first used, for instance to be written once."""
        return EventFrames(lambda: keep(self.events, "events"), lambda: keep(self.items, "items"))


def read_export(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Raw export rows, bounded on the ``yyyyMMdd`` text so that partitions are pruned.

    The text is compared directly: the format sorts like the date, and a predicate on the bare
    column also reaches Parquet row-group statistics when the table is not partitioned.
    """
    return within_dates(spark.read.schema(EVENT_SCHEMA).parquet(path), first, last)


def store_export(export: DataFrame, path: str) -> None:
    """Write an export with a folder per day, which :func:`read_export` prunes to the days of a window.

    Rows are dealt by ranges of day and time, so a file holds few days and a day with most of the
    events is cut over many files.
    """
    export.repartitionByRange("event_date", "event_timestamp").write.partitionBy("event_date").mode("overwrite").parquet(path)


def within_dates(export: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Date-bounded scan; either bound may be open, both are inclusive."""
    if first is not None:
        export = export.filter(F.col("event_date") >= first.strftime("%Y%m%d"))
    if last is not None:
        export = export.filter(F.col("event_date") <= last.strftime("%Y%m%d"))
    return export


def explode_items(export: DataFrame) -> DataFrame:
    """One row per item; events with a NULL or empty item list produce none."""
    return export.withColumn("item", F.explode("items")).drop("items")


def flatten(export: DataFrame) -> EventFrames:
    """Typed, flat event and item frames of a nested export."""
    return EventFrames(lambda: _flat_events(export), lambda: _flat_items(export))


def _day_and_identity() -> list[Column]:
    return [
        F.to_date("event_date", "yyyyMMdd").alias("event_day"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("user_pseudo_id").cast("string").alias("user_pseudo_id"),
    ]


def _flat_events(export: DataFrame) -> DataFrame:
    params = F.col("event_params")
    session_number = param_int(params, "ga_session_id")
    # concat, not concat_ws: a missing half must make the session id NULL.
    session_id = F.concat(F.col("user_pseudo_id"), F.lit("_"), session_number.cast("string"))
    return export.select(
        *_day_and_identity(),
        "event_timestamp",
        "event_name",
        session_id.alias("session_id"),
        param_string(params, "session_engaged").alias("session_engaged"),
        param_int(params, "engagement_time_msec").alias("engagement_time_msec"),
        param_string(params, "campaign").alias("campaign"),
        param_string(params, "medium").alias("medium"),
        param_string(params, "source").alias("source"),
        F.col("traffic_source.source").alias("visit_source"),
        F.col("traffic_source.medium").alias("visit_medium"),
        F.col("traffic_source.name").alias("visit_campaign"),
        *[F.col(f"ecommerce.{name}").alias(name) for name in ECOMMERCE_FIELDS],
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.language").alias("language"),
    )


def _flat_items(export: DataFrame) -> DataFrame:
    exploded = explode_items(
        export.select(
            *_day_and_identity(),
            F.col("ecommerce.transaction_id").alias("transaction_id"),
            F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
            "items",
        )
    )
    return exploded.select(
        "event_day",
        "user_id",
        "user_pseudo_id",
        "transaction_id",
        "purchase_revenue",
        *[F.col(f"item.{name}").alias(name) for name in ITEM_FIELDS],
    )
