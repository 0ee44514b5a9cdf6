"""Point-in-time history without inequality joins.

"Everything strictly before this date" is computed as a running window over daily aggregates.
After the daily aggregation a key holds at most one row per calendar day, so even a key that owns
a third of all events is a short, bounded window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returnscope.config import ROLLING_WINDOWS
from returnscope.functions.rates import is_positive
from returnscope.functions.strings import UNKNOWN, normalize_string
from returnscope.operators.aggregates import daily_totals
from returnscope.operators.lookups import Lookups, valid_transactions
from returnscope.sources.export import EventFrames

DAY = "transaction_date"


def broadcast_daily(daily: DataFrame) -> DataFrame:
    """Broadcast a table with one row per calendar day.

    Its size is bounded by the number of days the data spans, not by the number of events, so it
    stays a few thousand rows at any volume.
    """
    return F.broadcast(daily)


def strictly_before(daily: DataFrame, wanted: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """For each wanted (keys, day): sums of the measures over that key's earlier days.

    ``daily`` has one row per (keys, day). ``wanted`` must be distinct on (keys, day), may name days
    that ``daily`` lacks, and keeps its other columns. Measures are NULL where there is no earlier
    day. Both inputs travel through one shuffle on the keys.
    """
    extra = [c for c in wanted.columns if c not in {*keys, DAY}]
    types = {f.name: f.dataType for f in [*daily.schema.fields, *wanted.schema.fields]}

    def null(name: str) -> Column:
        return F.lit(None).cast(types[name]).alias(name)

    observed = daily.select(*keys, DAY, *measures, *[null(c) for c in extra], F.lit(False).alias("_wanted"))
    asked = wanted.select(*keys, DAY, *[null(c) for c in measures], *extra, F.lit(True).alias("_wanted"))
    earlier = Window.partitionBy(*keys).orderBy(F.unix_date(DAY)).rangeBetween(Window.unboundedPreceding, -1)
    return (
        observed.unionByName(asked)
        .select(*keys, DAY, *extra, "_wanted", *[F.sum(m).over(earlier).alias(m) for m in measures])
        .filter("_wanted")
        .drop("_wanted")
    )


def past_global_history(frames: EventFrames, lookups: Lookups) -> DataFrame:
    """Totals over all earlier valid transactions per lookup date, and the two overall rates.

    The only window without a partition key; it runs over one row per day.
    """
    amounts = ["purchase_revenue_in_usd", "purchase_revenue", "refund_value_in_usd", "refund_value"]
    daily = (
        frames.events.transform(valid_transactions(lookups.window.end))
        .groupBy(F.col("event_day").alias(DAY))
        .agg(
            *[F.sum(a).alias(a) for a in amounts],
            F.sum(is_positive(F.col("refund_value"))).alias("refund_count"),
            F.sum(is_positive(F.col("purchase_revenue"))).alias("trans_count"),
        )
    )
    earlier = Window.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    past = daily.select(
        DAY,
        *[F.sum(a).over(earlier).alias(f"past_{a}") for a in amounts],
        F.coalesce(F.sum("refund_count").over(earlier), F.lit(0)).alias("past_refund_count"),
        F.coalesce(F.sum("trans_count").over(earlier), F.lit(0)).alias("past_trans_count"),
    ).filter(F.col(DAY) >= F.lit(lookups.window.transaction_start))
    return past.withColumns(
        {
            "past_grand_avg_refund_amt_proportion": F.try_divide("past_refund_value", "past_purchase_revenue"),
            "past_grand_avg_refund_rate": F.try_divide("past_refund_count", "past_trans_count"),
        }
    )


def with_prior(df: DataFrame, prior: DataFrame) -> DataFrame:
    """Attach the overall rates of the row's date, used as the smoothing prior."""
    return df.join(
        broadcast_daily(
            prior.select(
                DAY,
                F.col("past_grand_avg_refund_rate").alias("prior_rate"),
                F.col("past_grand_avg_refund_amt_proportion").alias("prior_amt"),
            )
        ),
        DAY,
        "left",
    )


LEVEL_MEASURES = ["past_refund_value", "past_purchase_revenue", "past_refund_count", "past_trans_count"]
VISITOR_LEVELS = ["country", "city", "device_category", "operating_system", "language"]
ITEM_LEVELS = ["item_brand", "item_category"]
TRAFFIC_LEVELS = ["source", "medium", "campaign"]


def level_value(level: str) -> Column:
    """Value under which an event or item counts for a level.

    A missing visitor level is a NULL level of its own, an item without brand or category counts
    as ``unknown``, and a missing traffic parameter makes the event not count.
    """
    if level in VISITOR_LEVELS:
        return normalize_string(F.col(level))
    if level in ITEM_LEVELS:
        return F.coalesce(normalize_string(F.col(level)), F.lit(UNKNOWN))
    return F.col(level)


def levels_daily(frames: EventFrames, lookups: Lookups, levels: Sequence[str]) -> DataFrame:
    """Daily refund and revenue sums per (dimension, value), for levels of one kind.

    Visitor levels count valid transactions; item and traffic levels read every event. All levels
    come from one scan: rows are unfolded per level and shrink again in the partial aggregation.
    """
    kinds = [VISITOR_LEVELS, ITEM_LEVELS, TRAFFIC_LEVELS]
    kind = next((k for k in kinds if set(levels) <= set(k)), None)
    if kind is None:
        raise ValueError(f"levels must be of one kind, got {list(levels)}")
    refund, revenue = F.col("refund_value"), F.col("purchase_revenue")
    rows = frames.events
    if kind is VISITOR_LEVELS:
        rows = rows.transform(valid_transactions(lookups.window.end))
    if kind is ITEM_LEVELS:
        rows, refund, revenue = frames.items, F.col("item_refund"), F.col("item_revenue")

    unfolded = rows.select(
        F.col("event_day").alias(DAY),
        refund.alias("refund"),
        revenue.alias("revenue"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("dimension"), level_value(c).alias("value")) for c in levels])),
    )
    if kind is TRAFFIC_LEVELS:
        unfolded = unfolded.filter(F.col("value").isNotNull())

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0.0)) if kind is TRAFFIC_LEVELS else F.sum(column)

    return unfolded.groupBy("dimension", "value", DAY).agg(
        total("refund").alias("past_refund_value"),
        total("revenue").alias("past_purchase_revenue"),
        F.sum(is_positive(F.col("refund"))).alias("past_refund_count"),
        F.sum(is_positive(F.col("revenue"))).alias("past_trans_count"),
    )


def past_by_level(frames: EventFrames, lookups: Lookups, level: str) -> DataFrame:
    """(lookup date, level): sums over all strictly earlier days, for every level seen before.

    A running total of a level holds from the day after it was reached until its next change;
    each such stretch is unfolded to its dates and kept where the date is a lookup date. That
    gives dates x levels rows as required, without an inequality or cross join.
    """
    dates = lookups.dates
    last = dates.agg(F.max(DAY)).scalar()
    by_day = Window.partitionBy(level).orderBy(DAY)
    daily = levels_daily(frames, lookups, [level]).withColumnRenamed("value", level)
    running = daily.select(
        level,
        F.col(DAY).alias("reached"),
        *[F.sum(m).over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias(m) for m in LEVEL_MEASURES],
        F.least(F.coalesce(F.lead(DAY).over(by_day), last), last).alias("until"),
    )
    unfolded = running.filter(F.col("reached") < F.col("until")).select(
        F.explode(F.sequence(F.date_add("reached", 1), F.col("until"))).alias(DAY), level, *LEVEL_MEASURES
    )
    result = unfolded.join(broadcast_daily(dates), DAY, "left_semi")
    if level in VISITOR_LEVELS:
        result = result.unionByName(_dates_without_history(frames, lookups, level))
    names = {"past_refund_value": "past_item_refund", "past_purchase_revenue": "past_item_revenue", "past_trans_count": "past_transaction_count"}
    return result.withColumnsRenamed(names) if level in ITEM_LEVELS else result


def _dates_without_history(frames: EventFrames, lookups: Lookups, level: str) -> DataFrame:
    """The earliest date has nothing before it and yields a single row with a NULL level."""
    first = frames.events.transform(valid_transactions(lookups.window.end)).agg(F.min("event_day")).scalar()
    return lookups.dates.filter(F.col(DAY) <= first).select(
        DAY,
        F.lit(None).cast("string").alias(level),
        F.lit(None).cast("double").alias("past_refund_value"),
        F.lit(None).cast("double").alias("past_purchase_revenue"),
        F.lit(0).cast("long").alias("past_refund_count"),
        F.lit(0).cast("long").alias("past_trans_count"),
    )


def rolling_refunds(frames: EventFrames, lookups: Lookups, calendar_days: bool = False) -> DataFrame:
    """Revenue and refunds over the preceding 3, 7 and 30 days that had transactions.

    The frame counts rows of the daily table, so days without transactions are skipped; with
    ``calendar_days`` the frame counts calendar days instead. Runs over one row per day.
    """
    daily = daily_totals(frames, lookups)
    columns: list[Column] = [F.col(DAY)]
    for n in ROLLING_WINDOWS:
        if calendar_days:
            frame = Window.orderBy(F.unix_date(DAY)).rangeBetween(-n, -1)
        else:
            frame = Window.orderBy(DAY).rowsBetween(-n, -1)
        value = F.sum("purchase_revenue").over(frame)
        refund = F.sum("refund_value").over(frame)
        columns += [
            value.alias(f"past_{n}_days_transaction_value"),
            refund.alias(f"past_{n}_days_refund_value"),
            F.coalesce(F.try_divide(refund, value), F.lit(0.0)).alias(f"past_{n}_days_refund_proportion"),
        ]
    return daily.select(*columns)
