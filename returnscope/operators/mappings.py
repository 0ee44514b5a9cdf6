"""Transaction to user, session and item mappings.

Each mapping first removes duplicates, which combines on the map side and so flattens a hot
transaction or user, and only then applies the semi-joins. Whether a lookup is broadcast is left
to the optimizer, which knows its size at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.config import TRANSACTION_KEYS, RunWindow
from returnscope.operators.lookups import Lookups
from returnscope.sources.export import EventFrames


def _keyed(rows: DataFrame, window: RunWindow, *others: str) -> DataFrame:
    """Distinct (transaction, date, others) inside the run's transaction dates."""
    complete = F.col("transaction_id").isNotNull()
    for name in others:
        complete = complete & F.col(name).isNotNull()
    return (
        rows.filter(complete & F.col("event_day").between(F.lit(window.transaction_start), F.lit(window.end)))
        .select("transaction_id", F.col("event_day").alias("transaction_date"), *others)
        .distinct()
    )


def transaction_identity(frames: EventFrames, lookups: Lookups, identity: str) -> DataFrame:
    """(transaction, date) to ``user_id`` or ``user_pseudo_id``."""
    return (
        _keyed(frames.events, lookups.window, identity)
        .join(lookups.transactions, TRANSACTION_KEYS, "left_semi")
        .join(lookups.identity(identity), identity, "left_semi")
    )


def transaction_identity_item(frames: EventFrames, lookups: Lookups, identity: str) -> DataFrame:
    """(transaction, date, item name) to ``user_id`` or ``user_pseudo_id``."""
    return (
        _keyed(frames.items, lookups.window, identity, "item_name")
        .join(lookups.transactions, TRANSACTION_KEYS, "left_semi")
        .join(lookups.items, "item_name", "left_semi")
        .join(lookups.identity(identity), identity, "left_semi")
    )


def transaction_session(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """(transaction, date) to session."""
    return (
        _keyed(frames.events, lookups.window, "session_id")
        .join(lookups.transactions, TRANSACTION_KEYS, "left_semi")
        .join(lookups.sessions, "session_id", "left_semi")
    )
