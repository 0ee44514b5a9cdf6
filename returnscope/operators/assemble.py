"""The wide feature row and its two customer segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import TRANSACTION_KEYS, CustomerType
from returnscope.functions.strings import UNKNOWN
from returnscope.operators.history import DAY, broadcast_daily

BASKET_ZERO_FILLED = [
    "item_count",
    "unique_item_id_count",
    "unique_item_name_count",
    "unique_item_category_count",
    "unique_item_brand_count",
    "min_price",
    "max_price",
    "avg_price",
    "std_price",
    "min_item_revenue",
    "max_item_revenue",
    "avg_item_revenue",
    "std_item_revenue",
    "min_quantity",
    "max_quantity",
    "avg_quantity",
    "std_quantity",
    "discounted_product_count",
    "calculated_past_product_refund_rate",
    "calculated_past_product_refund_amt_proportion",
    "max_same_item_item_quantity",
    "min_same_item_item_quantity",
    "avg_same_item_item_quantity",
    "same_item_in_transaction_flag",
    "max_same_item_variant_quantity",
    "min_same_item_variant_quantity",
    "avg_same_item_variant_quantity",
    "same_item_variant_in_transaction_flag",
]
BASKET_RENAMED = {f"{s}_quantity": f"{s}_item_quantity" for s in ["min", "max", "avg", "std"]}

SESSION_RENAMED = {
    "session_length_in_seconds": "session_length_in_seconds",
    "engaged_sessions": "website_engaged_sessions",
    "engagement_time_seconds": "web_traffic_engagement_time_seconds",
}

# Feature column to history column, the user's own value before the pseudo-user's.
USER_HISTORY = {
    c: c
    for c in [
        "past_user_purchase_revenue",
        "past_user_refund_value",
        "past_user_refund_count",
        "past_user_transaction_count",
        "calculated_past_user_refund_rate",
        "calculated_past_user_refund_amt_proportion",
    ]
}
USER_ITEM_HISTORY = {
    "past_user_same_item_purchase_amt": "past_purchase_amt",
    "past_user_same_item_refund_amt": "past_refund_amt",
    "past_user_same_item_refund_count": "past_refund_count",
    "past_user_same_item_transaction_count": "past_transaction_count",
    "calculated_past_user_item_refund_rate": "calculated_past_user_item_refund_rate",
    "calculated_past_user_item_refund_amt_proportion": "calculated_past_user_item_refund_amt_proportion",
}
PAST_USER_COLUMNS = [*USER_HISTORY, *USER_ITEM_HISTORY]

INPUTS = [
    "basket",
    "session",
    "pseudo_user",
    "user",
    "user_item",
    "pseudo_user_item",
    "rolling",
    "demographics",
    "brand_category",
    "traffic",
]


def prefer_user_over_pseudo(keys: DataFrame, user: DataFrame, pseudo_user: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Per transaction of ``keys``: the user's value, else the pseudo-user's, else 0.

    Every column falls back to its own counterpart, the transaction count included.
    """
    own = user.select(*TRANSACTION_KEYS, *[F.col(c).alias(f"u_{name}") for name, c in columns.items()])
    fallback = pseudo_user.select(*TRANSACTION_KEYS, *[F.col(c).alias(f"p_{name}") for name, c in columns.items()])
    joined = _with_part(_with_part(keys, own), fallback)
    return joined.select(*keys.columns, *[F.coalesce(f"u_{n}", f"p_{n}", F.lit(0)).alias(n) for n in columns])


def _with_part(rows: DataFrame, part: DataFrame) -> DataFrame:
    """Join a table with a row per transaction; never by broadcast, which would send it through the driver while its files are small."""
    return rows.join(part.hint("merge"), TRANSACTION_KEYS, "left")


def customer_type(past_purchase: Column) -> Column:
    return F.when(F.coalesce(past_purchase, F.lit(0)) == 0, CustomerType.FIRST.value).otherwise(
        CustomerType.EXISTING.value
    )


def assemble_features(targets: DataFrame, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Left-join every feature table onto the targets.

    All inputs but the daily one are aggregated on the transaction keys, so these joins reuse that
    partitioning; the daily table is broadcast. With a part ``sparse_events``, the row holds its arrays
    in place of a column per event name and measure.
    """
    # Events come as a column each, or all in arrays.
    events = ["sparse_events"] if "sparse_events" in parts else ["event_length", "event_count"]
    lacking = [name for name in [*INPUTS, *events] if name not in parts]
    if lacking:
        raise ValueError(f"missing feature tables: {lacking}")

    basket = parts["basket"].select(
        *TRANSACTION_KEYS, *[F.col(c).alias(BASKET_RENAMED.get(c, c)) for c in BASKET_ZERO_FILLED]
    )
    session = parts["session"].select(
        *TRANSACTION_KEYS,
        *[F.col(c).alias(name) for c, name in SESSION_RENAMED.items()],
        F.col("channel_grouping_user").alias("web_traffic_channel_grouping_user"),
    )
    row = targets.withColumnRenamed("purchase_revenue", "transaction_value").select(
        *TRANSACTION_KEYS, "transaction_value", "refund_value", "refund_flag", "refund_proportion", "shipping_value"
    )
    zeros = [c for c in [*basket.columns, *session.columns] if c not in {*TRANSACTION_KEYS, "web_traffic_channel_grouping_user"}]
    row = (
        _with_part(_with_part(row, basket), session)
        .withColumns(
            {
                **{c: F.coalesce(F.col(c), F.lit(0)) for c in zeros},
                "web_traffic_channel_grouping_user": F.coalesce("web_traffic_channel_grouping_user", F.lit(UNKNOWN)),
            }
        )
    )
    row = _with_part(row, parts["traffic"])
    row = prefer_user_over_pseudo(row, parts["user"], parts["pseudo_user"], USER_HISTORY)
    row = prefer_user_over_pseudo(row, parts["user_item"], parts["pseudo_user_item"], USER_ITEM_HISTORY)
    for name in ["brand_category", *events, "demographics"]:
        row = _with_part(row, parts[name])
    row = row.join(broadcast_daily(parts["rolling"]), DAY, "left")
    first = [*TRANSACTION_KEYS, *[c for c in row.columns if c not in TRANSACTION_KEYS]]
    return row.select(*first).withColumn("customer_type", customer_type(F.col("past_user_purchase_revenue")))


def _segment(features: DataFrame, kind: CustomerType) -> DataFrame:
    """Rows of one customer type; the first day has no rolling history and is left out."""
    return features.filter(
        (F.col("customer_type") == kind.value) & F.col("past_30_days_transaction_value").isNotNull()
    ).drop("customer_type")


def existing_customers(features: DataFrame) -> DataFrame:
    return _segment(features, CustomerType.EXISTING)


def first_time_purchases(features: DataFrame) -> DataFrame:
    """First purchases; without the columns about the customer's past, which are empty here."""
    return _segment(features, CustomerType.FIRST).drop(*PAST_USER_COLUMNS)
