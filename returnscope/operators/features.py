"""Feature tables, one row per (transaction, date).

Every table ends in an aggregation on the same two keys, so the later assembly finds its inputs
already partitioned by them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.config import MAX_VOCABULARY, TRANSACTION_KEYS
from returnscope.functions.rates import is_positive, smoothed_rate
from returnscope.functions.strings import UNKNOWN, clean_string
from returnscope.operators.history import (
    DAY,
    ITEM_LEVELS,
    LEVEL_MEASURES,
    TRAFFIC_LEVELS,
    VISITOR_LEVELS,
    levels_daily,
    strictly_before,
    with_prior,
)
from returnscope.operators.lookups import Lookups
from returnscope.operators.skew import is_small, spread_join
from returnscope.operators.sparse import dictionary, gathered
from returnscope.sources.export import EventFrames
from returnscope.sources.tables import bounded_values, stage


def targets(totals: DataFrame) -> DataFrame:
    """Labels and transaction value."""
    return totals.groupBy(*TRANSACTION_KEYS).agg(
        F.sum("purchase_revenue").alias("purchase_revenue"),
        F.sum("refund_value").alias("refund_value"),
        F.when(F.sum("refund_value") > 0, 1).otherwise(0).alias("refund_flag"),
        F.try_divide(F.sum("refund_value"), F.sum("purchase_revenue")).alias("refund_proportion"),
        F.avg("shipping_value").alias("shipping_value"),
    )


# --- basket -----------------------------------------------------------------------------------


def _by_variant(item_stats: DataFrame) -> DataFrame:
    """Quantity per (transaction, item name, variant), partitioned by transaction.

    Item statistics have one row per item id, so a transaction has no more rows than the catalogue
    has items. One shuffle on the transaction then serves every further grouping below.
    """
    return (
        item_stats.select(*TRANSACTION_KEYS, "item_name", "item_variant", "quantity")
        .repartition(*TRANSACTION_KEYS)
        .groupBy(*TRANSACTION_KEYS, "item_name", "item_variant")
        .agg(F.sum("quantity").alias("quantity"))
    )


def _repeats(counted: Column, fewest: Column, mean: Column, what: str, flag: str) -> list[Column]:
    return [
        counted.alias(f"max_{what}"),
        fewest.alias(f"min_{what}"),
        mean.alias(f"avg_{what}"),
        F.when(counted > 1, 1).otherwise(0).alias(flag),
    ]


def same_item_summary(item_stats: DataFrame) -> DataFrame:
    """How often the same item name is repeated in a basket."""
    summaries = repeat_summaries(item_stats)
    return summaries.select(*TRANSACTION_KEYS, *[c for c in summaries.columns if "same_item" in c and "variant" not in c])


def same_variant_summary(item_stats: DataFrame) -> DataFrame:
    """As :func:`same_item_summary`, by item name and variant."""
    summaries = repeat_summaries(item_stats)
    return summaries.select(*TRANSACTION_KEYS, *[c for c in summaries.columns if "variant" in c])


def repeat_summaries(item_stats: DataFrame) -> DataFrame:
    """Repetition of items and of item variants within a basket, and its number of item names."""
    by_name = (
        _by_variant(item_stats)
        .groupBy(*TRANSACTION_KEYS, "item_name")
        .agg(
            F.sum("quantity").alias("of_item"),
            F.max("quantity").alias("most_of_variant"),
            F.min("quantity").alias("least_of_variant"),
            F.count("quantity").alias("variants"),
        )
    )
    return by_name.groupBy(*TRANSACTION_KEYS).agg(
        F.count("*").alias("unique_item_name_count"),
        *_repeats(
            F.max("of_item"), F.min("of_item"), F.avg("of_item"), "same_item_item_quantity", "same_item_in_transaction_flag"
        ),
        *_repeats(
            F.max("most_of_variant"),
            F.min("least_of_variant"),
            F.try_divide(F.sum("of_item"), F.sum("variants")),
            "same_item_variant_quantity",
            "same_item_variant_in_transaction_flag",
        ),
    )


PRODUCT_HISTORY = [
    "past_product_refund_count",
    "past_product_transaction_count",
    "past_product_refund_amt",
    "past_product_revenue_amt",
]


def past_product_history(item_stats: DataFrame, product_days: DataFrame) -> DataFrame:
    """Per (date, item id): history of the item's product strictly before that date.

    Counts are numbers of product days with revenue. An item id sold in several transactions on
    one date counts its history once per sale; that multiplicity defines the numbers and is kept.
    """
    daily = product_days.filter(F.col("item_revenue") > 0).select(
        "item_name",
        DAY,
        is_positive(F.col("item_refund")).alias("past_product_refund_count"),
        F.lit(1).cast("long").alias("past_product_transaction_count"),
        F.col("item_refund").alias("past_product_refund_amt"),
        F.col("item_revenue").alias("past_product_revenue_amt"),
    )
    history = stage(strictly_before(daily, item_stats.select("item_name", DAY).distinct(), ["item_name"], PRODUCT_HISTORY), "product_history")
    if is_small(history):
        # It goes to the items, which one shuffle then sums.
        each = item_stats.select("item_name", DAY, "item_id").join(F.broadcast(history), ["item_name", DAY])
        return each.groupBy(DAY, "item_id").agg(*[F.sum(m).alias(m) for m in PRODUCT_HISTORY])
    sold = item_stats.groupBy("item_name", DAY, "item_id").agg(F.count("*").alias("sales"))
    return (
        spread_join(sold, history, ["item_name", DAY], "inner", ["item_id"])
        .groupBy(DAY, "item_id")
        .agg(*[F.sum(F.col(m) * F.col("sales")).alias(m) for m in PRODUCT_HISTORY])
    )


BASKET_LISTS = {
    "item_brands": "item_brand",
    "item_names": "item_name",
    "item_variants": "item_variant",
    "item_categories": "item_category",
}


def _listed(values: Column) -> Column:
    """Comma-separated text of values that are sorted, so that it is reproducible."""
    return F.array_join(values, ",")


def basket_description(item_stats: DataFrame, product_history: DataFrame, prior: DataFrame) -> DataFrame:
    """Counts, attribute lists and distributions over the basket, product refund rates, and repeat summaries."""

    def spread(column: str, name: str) -> list[Column]:
        return [
            F.min(column).alias(f"min_{name}"),
            F.max(column).alias(f"max_{name}"),
            F.avg(column).alias(f"avg_{name}"),
            F.coalesce(F.stddev_samp(column), F.lit(0.0)).alias(f"std_{name}"),
        ]

    described = item_stats.groupBy(*TRANSACTION_KEYS).agg(
        F.count("*").alias("item_count"),
        # Item ids are unique within a basket, so a plain count is the distinct count.
        F.count("item_id").alias("unique_item_id_count"),
        *spread("price", "price"),
        *spread("item_revenue", "item_revenue"),
        *spread("quantity", "quantity"),
        F.sum(F.col("discounted_product_flag").cast("long")).alias("discounted_product_count"),
        # Distinct kinds are counted in the gathered values; distinct counts would multiply the rows and shuffle them twice.
        *[F.sort_array(F.collect_list(c)).alias(name) for name, c in BASKET_LISTS.items()],
    )
    kinds = {"unique_item_category_count": "item_categories", "unique_item_brand_count": "item_brands"}
    described = described.withColumns({name: F.size(F.array_distinct(c)).cast("long") for name, c in kinds.items()})
    described = described.withColumns({name: _listed(F.col(name)) for name in BASKET_LISTS})
    history = (
        # An item that most baskets of a day hold would be one key. The join moves the keys alone.
        spread_join(item_stats.select(*TRANSACTION_KEYS, "item_id"), product_history, [DAY, "item_id"], "left", ["transaction_id"])
        .groupBy(*TRANSACTION_KEYS)
        .agg(*[F.sum(m).alias(m) for m in PRODUCT_HISTORY])
    )
    described = described.join(history, TRANSACTION_KEYS, "left")
    rated = with_prior(described, prior).withColumns(
        {
            "calculated_past_product_refund_rate": smoothed_rate(
                F.col("past_product_refund_count"), F.col("prior_rate"), F.col("past_product_transaction_count")
            ),
            "calculated_past_product_refund_amt_proportion": smoothed_rate(
                F.col("past_product_refund_amt"), F.col("prior_amt"), F.col("past_product_revenue_amt")
            ),
        }
    )
    last = [*kinds, *BASKET_LISTS]
    plain = [c for c in rated.columns if c not in {"prior_rate", "prior_amt", *PRODUCT_HISTORY, *last}]
    repeats = repeat_summaries(item_stats)
    joined = rated.join(repeats, TRANSACTION_KEYS, "left")
    return joined.select(*plain, *[c for c in repeats.columns if c not in TRANSACTION_KEYS], *last)


def basket_lists(item_stats: DataFrame) -> DataFrame:
    """The lists of :func:`basket_description` alone."""
    return item_stats.groupBy(*TRANSACTION_KEYS).agg(
        *[_listed(F.sort_array(F.collect_list(c))).alias(name) for name, c in BASKET_LISTS.items()]
    )


# --- sessions and web events ------------------------------------------------------------------


def session_features(session_map: DataFrame, traffic: DataFrame) -> DataFrame:
    """Length and engagement over a transaction's sessions, and one cleaned traffic origin."""

    def total(column: str) -> Column:
        return F.sum(F.coalesce(column, F.lit(0))).alias(column)

    def origin(value: Column, name: str) -> Column:
        return F.coalesce(F.min(value), F.lit(UNKNOWN)).alias(name)

    return (
        session_map.join(traffic, "session_id", "left")
        .groupBy(*TRANSACTION_KEYS)
        .agg(
            *[total(c) for c in ["session_length_in_seconds", "engaged_sessions", "engagement_time_seconds"]],
            *[origin(clean_string(F.col(c)), c) for c in ["campaign", "medium", "source"]],
            origin(F.col("channel_grouping_user"), "channel_grouping_user"),
        )
    )


EVENT_MEASURES = ["event_count", "event_length_in_seconds"]


def web_events(session_map: DataFrame, events_of_session: DataFrame) -> DataFrame:
    """(transaction, date, event name): time span and number of events over its sessions."""
    return (
        session_map.join(events_of_session, "session_id", "left")
        .groupBy(*TRANSACTION_KEYS, "event_name")
        .agg(
            F.sum("event_length_in_seconds").alias("event_length_in_seconds"),
            F.sum("event_count").alias("event_count"),
        )
    )


def event_vocabulary(observed: DataFrame) -> list[str]:
    """Event names that become columns; taken from training and stored with the model.

    A column each suits a few names only; :func:`sparse_events` takes any number.
    """
    return bounded_values(observed, "event_name", MAX_VOCABULARY)


def event_dictionary(observed: DataFrame) -> DataFrame:
    """Every observed event name with its position; stored with the model, whatever its length."""
    return dictionary(observed, ["event_name"])


def sparse_events(observed: DataFrame, names: DataFrame) -> DataFrame:
    """Per transaction the positions of its events in the dictionary ``names``, and their measures beside them.

    Where there is no entry, the measure is 0. Events that the dictionary lacks, such as those seen
    only in prediction, have no position; a transaction with no others has empty arrays.
    """
    return gathered(observed, names, ["event_name"], TRANSACTION_KEYS, EVENT_MEASURES, "event_positions")


def pivot_events(observed: DataFrame, measure: str, vocabulary: Sequence[str]) -> DataFrame:
    """One column ``<measure>_<event name>`` per vocabulary entry, 0 where nothing was observed.

    A transaction's events are gathered into one map, so the aggregation has a single buffer however
    many columns are read from it. Names seen only in training still get their column at prediction time.
    """
    held = F.col("event_name").isNotNull() & F.col(measure).isNotNull()
    found = F.map_from_entries(F.collect_list(F.when(held, F.struct("event_name", measure))))
    wide = observed.groupBy(*TRANSACTION_KEYS).agg(found.alias("found"))
    zero = F.lit(0).cast(dict(observed.dtypes)[measure])
    return wide.select(
        *TRANSACTION_KEYS, *[F.coalesce(F.col("found")[F.lit(name)], zero).alias(f"{measure}_{name}") for name in vocabulary]
    )


def event_grid(observed: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Web events completed over a vocabulary: every (transaction, event name), zeros included.

    One aggregation gathers a transaction's measures by name, and the vocabulary unfolds them again,
    instead of a cross join with the vocabulary and a join back.
    """
    entry = F.when(F.col("event_name").isNotNull(), F.struct("event_name", F.struct(*EVENT_MEASURES)))
    found = observed.groupBy(*TRANSACTION_KEYS).agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
    unfolded = found.select(*TRANSACTION_KEYS, "found", F.explode(F.lit(list(vocabulary))).alias("event_name"))
    here = F.col("found")[F.col("event_name")]
    return unfolded.select(
        *TRANSACTION_KEYS,
        "event_name",
        F.coalesce(here["event_length_in_seconds"], F.lit(0.0)).alias("event_length_in_seconds"),
        F.coalesce(here["event_count"], F.lit(0)).alias("event_count"),
    )


# --- customer history -------------------------------------------------------------------------


def _history_of_mapping(
    mapping: DataFrame, daily: DataFrame, keys: Sequence[str], measures: Sequence[str], zero_without_history: Sequence[str]
) -> DataFrame:
    """Earlier sums per mapping key and date, added up per transaction.

    ``daily`` carries a column ``days`` of ones. Two effects of counting joined rows are part of
    the numbers: a key without history counts as one day, and a key with m transactions on a date
    counts its history m times in each of them.
    """
    wanted = mapping.groupBy(*keys, DAY).agg(F.count("*").alias("multiplicity"))
    past = strictly_before(daily, wanted, keys, [*measures, "days"])
    filled = {m: F.coalesce(F.col(m), F.lit(0)) for m in zero_without_history}
    filled["days"] = F.greatest(F.coalesce(F.col("days"), F.lit(1)), F.lit(1))
    times = F.col("multiplicity")
    weighted = past.select(*keys, DAY, *[(filled.get(m, F.col(m)) * times).alias(m) for m in [*measures, "days"]])
    return (
        mapping.join(weighted, [*keys, DAY], "left")
        .groupBy(*TRANSACTION_KEYS)
        .agg(*[F.sum(m).alias(m) for m in [*measures, "days"]])
    )


def past_identity(mapping: DataFrame, daily: DataFrame, prior: DataFrame, identity: str) -> DataFrame:
    """Purchase and refund history of a transaction's user before its date, with smoothed rates.

    For ``user_pseudo_id`` a missing refund sum counts as 0; for ``user_id`` it stays NULL, and so
    does the amount rate built on it.
    """
    zero_refund = identity == "user_pseudo_id"
    refund = F.coalesce("refund_value", F.lit(0.0)) if zero_refund else F.col("refund_value")
    days = daily.select(
        identity,
        DAY,
        refund.alias("refund_amt"),
        F.coalesce("purchase_revenue", F.lit(0.0)).alias("purchase_amt"),
        is_positive(F.col("refund_value")).alias("refund_count"),
        F.lit(1).cast("long").alias("days"),
    )
    zeros = ["purchase_amt", "refund_count"] + (["refund_amt"] if zero_refund else [])
    totals = _history_of_mapping(mapping, days, [identity], ["refund_amt", "purchase_amt", "refund_count"], zeros)
    return with_prior(totals, prior).select(
        *TRANSACTION_KEYS,
        F.col("purchase_amt").alias("past_user_purchase_revenue"),
        F.col("refund_amt").alias("past_user_refund_value"),
        F.col("refund_count").alias("past_user_refund_count"),
        F.col("days").alias("past_user_transaction_count"),
        smoothed_rate(F.col("refund_count"), F.col("prior_rate"), F.col("days")).alias("calculated_past_user_refund_rate"),
        smoothed_rate(F.col("refund_amt"), F.col("prior_amt"), F.col("purchase_amt")).alias(
            "calculated_past_user_refund_amt_proportion"
        ),
    )


def past_identity_item(mapping: DataFrame, daily: DataFrame, prior: DataFrame, identity: str) -> DataFrame:
    """History of the same user with the same items, added up over the basket."""
    days = daily.select(
        identity,
        "item_name",
        DAY,
        F.col("item_refund").alias("refund_amt"),
        F.col("item_revenue").alias("purchase_amt"),
        is_positive(F.col("item_refund")).alias("refund_count"),
        F.lit(1).cast("long").alias("days"),
    )
    totals = _history_of_mapping(
        mapping, days, [identity, "item_name"], ["refund_amt", "purchase_amt", "refund_count"], ["refund_count"]
    )
    return with_prior(totals, prior).select(
        *TRANSACTION_KEYS,
        F.col("purchase_amt").alias("past_purchase_amt"),
        F.col("refund_amt").alias("past_refund_amt"),
        F.col("refund_count").alias("past_refund_count"),
        F.col("days").alias("past_transaction_count"),
        smoothed_rate(F.col("refund_count"), F.col("prior_rate"), F.col("days")).alias("calculated_past_user_item_refund_rate"),
        smoothed_rate(F.col("refund_amt"), F.col("prior_amt"), F.col("purchase_amt")).alias(
            "calculated_past_user_item_refund_amt_proportion"
        ),
    )


# --- level rates ------------------------------------------------------------------------------


def _level_rates(
    rows: DataFrame, daily: DataFrame, prior: DataFrame, levels: Sequence[str], names: dict[str, str]
) -> DataFrame:
    """Smoothed refund rates of a transaction's levels before its date, 0 where unknown.

    ``rows`` has the transaction keys and one column per level, ``daily`` comes from
    :func:`levels_daily`. Levels are stacked into (dimension, value) pairs, so all of them share
    one history window, one join and one aggregation. Only the (value, date) pairs that occur are
    looked up, which is far less than the full dates x levels table.
    """
    stacked = rows.select(
        *TRANSACTION_KEYS,
        F.inline(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in levels])),
    )
    wanted = stacked.filter(F.col("value").isNotNull()).select("dimension", "value", DAY).distinct()
    past = stage(strictly_before(daily, wanted, ["dimension", "value"], LEVEL_MEASURES), "level_history")
    on = ["dimension", "value", DAY]
    if is_small(past):
        dated = stacked.join(F.broadcast(past), on, "left")
    else:
        # A country or language that most transactions share would be one key.
        dated = spread_join(stacked, past, on, "left", ["transaction_id"])

    def total(level: str, measure: str) -> Column:
        return F.sum(F.when(F.col("dimension") == level, F.col(measure))).alias(f"{level}__{measure}")

    summed = dated.groupBy(*TRANSACTION_KEYS).agg(*[total(level, m) for level in levels for m in LEVEL_MEASURES])

    def rate(level: str, hits: str, prior_column: str, trials: str) -> Column:
        smoothed = smoothed_rate(F.col(f"{level}__{hits}"), F.col(prior_column), F.col(f"{level}__{trials}"))
        return F.coalesce(smoothed, F.lit(0.0))

    columns = []
    for level in levels:
        stem = f"calculated_past_{names[level]}_refund"
        columns += [
            rate(level, "past_refund_count", "prior_rate", "past_trans_count").alias(f"{stem}_rate"),
            rate(level, "past_refund_value", "prior_amt", "past_purchase_revenue").alias(f"{stem}_amt_proportion"),
        ]
    return with_prior(summed, prior).select(*TRANSACTION_KEYS, *columns)


def transaction_demographics(
    lookups: Lookups, user_map: DataFrame, users: DataFrame, pseudo_map: DataFrame, pseudo_users: DataFrame
) -> DataFrame:
    """Country, city, device and language per transaction: of the user, else of the pseudo-user.

    A transaction with several users has several rows.
    """
    combined = lookups.transactions
    for identity, prefix, mapping, attributes in (
        ("user_pseudo_id", "pseudo_", pseudo_map, pseudo_users),
        ("user_id", "user_", user_map, users),
    ):
        of_identity = mapping.join(attributes, identity, "left")
        combined = combined.join(
            of_identity.select(*TRANSACTION_KEYS, *[F.col(c).alias(prefix + c) for c in VISITOR_LEVELS]),
            TRANSACTION_KEYS,
            "left",
        )
    return combined.select(
        *TRANSACTION_KEYS,
        *[F.coalesce(f"user_{c}", f"pseudo_{c}", F.lit(UNKNOWN)).alias(c) for c in VISITOR_LEVELS],
    )


def demographic_rates(of_transaction: DataFrame, frames: EventFrames, lookups: Lookups, prior: DataFrame) -> DataFrame:
    """``of_transaction`` is the output of :func:`transaction_demographics`."""
    names = {
        "country": "country",
        "city": "city",
        "device_category": "device_category",
        "operating_system": "device_operating_system",
        "language": "device_language",
    }
    return _level_rates(of_transaction, levels_daily(frames, lookups, VISITOR_LEVELS), prior, VISITOR_LEVELS, names)


def brand_category_rates(item_stats: DataFrame, frames: EventFrames, lookups: Lookups, prior: DataFrame) -> DataFrame:
    names = {"item_brand": "brand", "item_category": "category"}
    return _level_rates(item_stats, levels_daily(frames, lookups, ITEM_LEVELS), prior, ITEM_LEVELS, names)


def traffic_rates(sessions: DataFrame, frames: EventFrames, lookups: Lookups, prior: DataFrame) -> DataFrame:
    """``sessions`` is the output of :func:`session_features`."""
    names = {c: f"traffic_{c}" for c in TRAFFIC_LEVELS}
    return _level_rates(sessions, levels_daily(frames, lookups, TRAFFIC_LEVELS), prior, TRAFFIC_LEVELS, names)
