"""First aggregation level: transactions, days, items, users and sessions.

Operators that restrict a wide scan to a key set aggregate first and semi-join afterwards: the
partial aggregation shrinks hot keys before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.config import TRANSACTION_KEYS
from returnscope.functions.params import earliest
from returnscope.functions.strings import NOT_SET, UNKNOWN, channel_grouping, normalize_string
from returnscope.operators.lookups import Lookups, valid_transactions
from returnscope.sources.export import EventFrames

REVENUE_AND_REFUND = ["purchase_revenue_in_usd", "purchase_revenue", "refund_value_in_usd", "refund_value"]
ITEM_AMOUNTS = ["item_revenue_in_usd", "item_revenue", "item_refund_in_usd", "item_refund"]


def _day():
    return F.col("event_day").alias("transaction_date")


def transaction_totals(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """Amounts per (transaction, date); only events on that date count."""
    amounts = [*REVENUE_AND_REFUND, "unique_items", "shipping_value", "shipping_value_in_usd"]
    return (
        frames.events.filter(
            F.col("transaction_id").isNotNull()
            & F.col("event_day").between(F.lit(lookups.window.transaction_start), F.lit(lookups.window.end))
        )
        .groupBy("transaction_id", _day())
        .agg(*[F.sum(a).alias(a) for a in amounts])
        .join(lookups.transactions, TRANSACTION_KEYS, "left_semi")
    )


def daily_totals(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """Amounts of valid transactions per day."""
    return (
        frames.events.transform(valid_transactions(lookups.window.end))
        .groupBy(_day())
        .agg(*[F.sum(a).alias(a) for a in REVENUE_AND_REFUND])
    )


def transaction_item_stats(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """One row per (date, transaction, item id) with its attributes and amounts.

    Where an item occurs with several spellings of an attribute, the smallest is taken. The first
    aggregation keys on the raw spellings: the item filter applies to the raw name, and with only
    numbers to aggregate it hashes instead of sorting. Rows are dealt by transaction once, which serves
    both aggregations and the join between them; the placeholder, no transaction at all, goes before.
    """
    descriptive = ["item_name", "item_brand", "item_variant", "item_category"]
    promotional = ["promotion_id", "promotion_name", "coupon"]
    promoted = F.lit(False)
    for c in promotional:
        promoted = promoted | (F.coalesce(normalize_string(F.col(c)), F.lit(UNKNOWN)) != UNKNOWN)
    spelled = (
        frames.items.filter(
            (F.col("transaction_id") != NOT_SET)
            & F.col("item_name").isNotNull()
            & F.col("event_day").between(F.lit(lookups.window.transaction_start), F.lit(lookups.window.end))
        )
        .select("transaction_id", _day(), "item_id", *descriptive, promoted.alias("promoted"), "price", "quantity", *ITEM_AMOUNTS)
        .repartition(*TRANSACTION_KEYS)
        .groupBy(*TRANSACTION_KEYS, "item_id", *descriptive)
        .agg(
            F.max("promoted").alias("promoted"),
            F.sum(F.coalesce("price", F.lit(0.0))).alias("price_sum"),
            F.count("*").alias("line_count"),
            F.sum("quantity").alias("quantity"),
            *[F.sum(a).alias(a) for a in ITEM_AMOUNTS],
        )
    )
    return (
        spelled.join(lookups.transactions, TRANSACTION_KEYS, "left_semi")
        .join(lookups.items, "item_name", "left_semi")
        .groupBy(*TRANSACTION_KEYS, "item_id")
        .agg(
            *[F.coalesce(F.min(normalize_string(F.col(c))), F.lit(UNKNOWN)).alias(c) for c in descriptive],
            F.max("promoted").alias("discounted_product_flag"),
            (F.sum("price_sum") / F.sum("line_count")).alias("price"),
            F.sum("quantity").alias("quantity"),
            *[F.sum(a).alias(a) for a in ITEM_AMOUNTS],
        )
    )


def product_daily(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """Amounts per (date, item name) over the whole history, without an upper date bound."""
    return (
        frames.items.filter(F.col("item_name").isNotNull())
        .groupBy(_day(), "item_name")
        .agg(*[F.sum(a).alias(a) for a in ITEM_AMOUNTS])
        .join(lookups.items, "item_name", "left_semi")
    )


def identity_daily(frames: EventFrames, lookups: Lookups, identity: str) -> DataFrame:
    """Amounts per (date, user); a day without any purchase still gives a row."""
    return (
        frames.events.filter(F.col(identity).isNotNull())
        .groupBy(_day(), identity)
        .agg(*[F.sum(a).alias(a) for a in [*REVENUE_AND_REFUND, "unique_items"]])
        .join(lookups.identity(identity), identity, "left_semi")
    )


def identity_item_daily(frames: EventFrames, lookups: Lookups, identity: str) -> DataFrame:
    """Amounts per (date, user, item name)."""
    return (
        frames.items.filter(F.col(identity).isNotNull() & F.col("item_name").isNotNull())
        .groupBy(_day(), identity, "item_name")
        .agg(*[F.sum(a).alias(a) for a in ITEM_AMOUNTS])
        .join(lookups.identity(identity), identity, "left_semi")
        .join(lookups.items, "item_name", "left_semi")
    )


def demographics(frames: EventFrames, lookups: Lookups, identity: str) -> DataFrame:
    """One country, city, device and language per user: the smallest recorded value."""
    columns = ["country", "city", "device_category", "operating_system", "language"]
    return (
        frames.events.filter(F.col(identity).isNotNull())
        .groupBy(identity)
        .agg(*[F.min(normalize_string(F.col(c))).alias(c) for c in columns])
        .join(lookups.identity(identity), identity, "left_semi")
    )


def session_event_facts(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """Mergeable facts per (session, event name), the base of both session tables.

    Every column is a sum, minimum or maximum, so a session is rolled up from these rows and the
    events are read and shuffled once.
    """
    at = F.col("event_timestamp")
    engaged = F.when(F.col("session_engaged") == "1", 1).otherwise(0)
    return (
        frames.events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id", "event_name")
        .agg(
            F.min(at).alias("first_at"),
            F.max(at).alias("last_at"),
            F.count("*").alias("event_count"),
            F.sum(engaged).alias("engaged"),
            F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("engagement_msec"),
            *[earliest(F.col(c), at).alias(c) for c in ["campaign", "medium", "source"]],
            F.min(channel_grouping(F.col("visit_source"), F.col("visit_medium"), F.col("visit_campaign"))).alias("channel"),
        )
        .join(lookups.sessions, "session_id", "left_semi")
    )


def session_traffic(facts: DataFrame) -> DataFrame:
    """Per session: bounds, length, engagement, and the first campaign, medium and source by time."""
    return facts.groupBy("session_id").agg(
        F.timestamp_micros(F.max("last_at")).alias("session_end"),
        F.timestamp_micros(F.min("first_at")).alias("session_start"),
        ((F.max("last_at") - F.min("first_at")) / 1_000_000).alias("session_length_in_seconds"),
        F.sum("engaged").alias("engaged_sessions"),
        (F.sum("engagement_msec") / 1000).alias("engagement_time_seconds"),
        *[F.min(c)["value"].alias(c) for c in ["campaign", "medium", "source"]],
        F.min("channel").alias("channel_grouping_user"),
    )


def session_events(facts: DataFrame) -> DataFrame:
    """Per (session, event name): time between first and last occurrence, and the number of them."""
    return facts.select(
        "session_id",
        "event_name",
        ((F.col("last_at") - F.col("first_at")) / 1_000_000).alias("event_length_in_seconds"),
        "event_count",
    )
