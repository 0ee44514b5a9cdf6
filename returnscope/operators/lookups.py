"""Distinct key sets of valid transactions; later scans are reduced to them by semi-joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import RunWindow
from returnscope.functions.strings import NOT_SET
from returnscope.sources.export import EventFrames
from returnscope.sources.tables import no_stage


def is_valid_transaction(end: dt.date) -> Column:
    """Revenue above zero and a real transaction id, on or before ``end``."""
    return (
        (F.col("purchase_revenue") > 0)
        & F.col("transaction_id").isNotNull()
        & (F.col("transaction_id") != NOT_SET)
        & (F.col("event_day") <= F.lit(end))
    )


def valid_transactions(end: dt.date) -> Callable[[DataFrame], DataFrame]:
    """For ``events.transform(valid_transactions(end))``."""
    return lambda events: events.filter(is_valid_transaction(end))


def _target_transactions(frames: EventFrames, window: RunWindow) -> DataFrame:
    return frames.events.transform(valid_transactions(window.end)).filter(
        F.col("event_day") >= F.lit(window.transaction_start)
    )


def transaction_lookup(frames: EventFrames, window: RunWindow) -> DataFrame:
    return (
        _target_transactions(frames, window)
        .select("transaction_id", F.col("event_day").alias("transaction_date"))
        .distinct()
    )


def transaction_date_lookup(frames: EventFrames, window: RunWindow) -> DataFrame:
    return _target_transactions(frames, window).select(F.col("event_day").alias("transaction_date")).distinct()


def identity_lookup(frames: EventFrames, window: RunWindow, identity: str) -> DataFrame:
    """Users with at least one valid transaction; ``identity`` is ``user_id`` or ``user_pseudo_id``."""
    return (
        frames.events.transform(valid_transactions(window.end))
        .filter(F.col(identity).isNotNull())
        .select(identity)
        .distinct()
    )


def session_lookup(frames: EventFrames, window: RunWindow) -> DataFrame:
    """Sessions that contain a valid transaction, bounded by the data recency."""
    return (
        frames.events.transform(valid_transactions(window.end))
        .filter(F.col("session_id").isNotNull() & (F.col("event_day") >= F.lit(window.start)))
        .select("session_id")
        .distinct()
    )


def item_lookup(frames: EventFrames, window: RunWindow) -> DataFrame:
    """Names of items sold with revenue in a valid transaction."""
    return (
        frames.items.transform(valid_transactions(window.end))
        .filter(
            (F.col("item_revenue") > 0)
            & (F.col("item_id") != NOT_SET)
            & (F.col("item_name") != NOT_SET)
        )
        .select("item_name")
        .distinct()
    )


class Lookups:
    """The key sets of a run, shared by all operators that restrict a scan to them.

    Each is built when first used. ``keep`` may write it once for all its readers; by default the
    key sets stay part of the plan.
    """

    def __init__(
        self, frames: EventFrames, window: RunWindow, keep: Callable[[DataFrame, str], DataFrame] = no_stage
    ) -> None:
        self.window = window
        self._frames = frames
        self._keep = keep

    @cached_property
    def transactions(self) -> DataFrame:
        return self._keep(transaction_lookup(self._frames, self.window), "transaction_lookup")

    @cached_property
    def dates(self) -> DataFrame:
        return self._keep(transaction_date_lookup(self._frames, self.window), "transaction_date_lookup")

    @cached_property
    def users(self) -> DataFrame:
        return self._keep(identity_lookup(self._frames, self.window, "user_id"), "user_lookup")

    @cached_property
    def pseudo_users(self) -> DataFrame:
        return self._keep(identity_lookup(self._frames, self.window, "user_pseudo_id"), "pseudo_user_lookup")

    @cached_property
    def sessions(self) -> DataFrame:
        return self._keep(session_lookup(self._frames, self.window), "session_lookup")

    @cached_property
    def items(self) -> DataFrame:
        return self._keep(item_lookup(self._frames, self.window), "item_lookup")

    def identity(self, identity: str) -> DataFrame:
        return {"user_id": lambda: self.users, "user_pseudo_id": lambda: self.pseudo_users}[identity]()
