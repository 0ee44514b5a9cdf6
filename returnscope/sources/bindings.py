"""The operators' input built from order tables and from a click-stream table.

Money is held as whole hundredths (web) or ten-thousandths (shop) in DOUBLE columns, so sums are
exact and do not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returnscope.sources.export import EventFrames, flatten
from returnscope.sources.schema import EVENT_SCHEMA, ITEM, PARAM


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _missing(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


# --- shop: orders and their lines --------------------------------------------------------------


def order_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Lines with exact amounts; returned lines count as refunded."""
    amount = (
        F.round(F.col("l_extendedprice") * 100).cast("long") * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    ).cast("double")
    return table(spark, directory, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("long").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("long").alias("discount_percent"),
        amount.alias("item_revenue"),
        F.when(F.col("l_returnflag") == "R", amount).alias("item_refund"),
    )


def _shop_headers(spark: SparkSession, directory: str) -> DataFrame:
    order_totals = order_lines(spark, directory).groupBy("l_orderkey").agg(
        F.sum("item_revenue").alias("purchase_revenue"),
        F.sum("item_refund").alias("refund_value"),
        F.count("*").alias("unique_items"),
    )
    orders = table(spark, directory, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("event_day"),
        F.col("o_orderpriority").alias("device_category"),
        F.col("o_orderstatus").alias("operating_system"),
    )
    return orders.join(order_totals, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def _shop_keys() -> list[Column]:
    customer, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    return [customer.alias("user_id"), customer.alias("user_pseudo_id"), order.alias("transaction_id")]


def _shop_events(spark: SparkSession, directory: str) -> DataFrame:
    nation = table(spark, directory, "nation").join(
        table(spark, directory, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = (
        table(spark, directory, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", F.col("n_name").alias("country"), F.col("c_mktsegment").alias("city"), F.col("r_name").alias("language"))
    )
    headers = _shop_headers(spark, directory)
    return headers.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "event_day",
        (F.unix_date("event_day").cast("long") * 86_400_000_000).alias("event_timestamp"),
        F.lit("purchase").alias("event_name"),
        *_shop_keys(),
        *[_missing().alias(c) for c in ["session_id", "session_engaged", "campaign", "medium", "source"]],
        *[_missing().alias(c) for c in ["visit_source", "visit_medium", "visit_campaign"]],
        _missing("long").alias("engagement_time_msec"),
        "purchase_revenue",
        F.col("purchase_revenue").alias("purchase_revenue_in_usd"),
        "refund_value",
        F.col("refund_value").alias("refund_value_in_usd"),
        _missing("double").alias("shipping_value"),
        _missing("double").alias("shipping_value_in_usd"),
        "unique_items",
        "country",
        "city",
        "device_category",
        "operating_system",
        "language",
    )


def _shop_items(spark: SparkSession, directory: str) -> DataFrame:
    """Lines with their order's total, which a window adds to them, so that they are dealt by order once."""
    of_order = F.sum("item_revenue").over(Window.partitionBy("l_orderkey"))
    lines = order_lines(spark, directory).filter("l_orderkey IS NOT NULL").withColumn("purchase_revenue", of_order)
    orders = table(spark, directory, "orders")
    return (
        orders.select(F.col("o_orderdate").cast("date").alias("event_day"), *_shop_keys(), "o_orderkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, directory, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            "event_day",
            "user_id",
            "user_pseudo_id",
            "transaction_id",
            "purchase_revenue",
            F.col("l_partkey").cast("string").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("item_brand"),
            F.col("p_size").cast("string").alias("item_variant"),
            F.col("p_type").alias("item_category"),
            _missing().alias("promotion_id"),
            _missing().alias("promotion_name"),
            F.when(F.col("discount_percent") >= 8, F.lit("SAVE")).alias("coupon"),
            F.round(F.col("p_retailprice") * 100).alias("price"),
            "quantity",
            "item_revenue",
            F.col("item_revenue").alias("item_revenue_in_usd"),
            "item_refund",
            F.col("item_refund").alias("item_refund_in_usd"),
        )
    )


def shop_frames(spark: SparkSession, directory: str) -> EventFrames:
    """One purchase event per order, one item per line."""
    return EventFrames(lambda: _shop_events(spark, directory), lambda: _shop_items(spark, directory))


# --- web: a click stream as a nested export ----------------------------------------------------

# What the bucket number of an event stands for.
VISIT_SOURCES = ["(direct)", "google", "facebook", "youtube", "amazon", "bing", "mail-email", "partner", "shop-news", "push-hub"]
VISIT_MEDIUMS = ["(none)", "organic", "cpc", "referral", "display", "social", "video-ad", "affiliate", "audio", "sms", "mobile push"]
VISIT_CAMPAIGNS = ["spring", "shopping-week", "cross-network-1", "brand", "(not set)", "a shop", "eshop", "retarget"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _over_all_cores(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over the cores where a small file leaves fewer partitions: to build an export row costs far more than to move its source."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)


def web_export(spark: SparkSession, directory: str) -> DataFrame:
    """Nested event export over the ``events`` table, one export row per event.

    ``k`` in the event's properties selects items, placeholders and traffic; purchases have
    transactions, and some errors are refunds booked without revenue.
    """
    source = _over_all_cores(table(spark, directory, "events"), "event_id").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("date").alias("day"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.round(F.col("value") * 100).alias("cents"),
    )
    k, user, cents = F.col("k"), F.col("user_id"), F.col("cents")
    purchase = F.col("event_type") == "purchase"
    refund_only = (F.col("event_type") == "error") & (k % 25 == 0)
    half_day = F.when(F.hour("ts") < 12, "a").otherwise("b")
    transaction = F.concat(F.lit("T"), user.cast("string"), F.lit("-"), F.date_format("day", "yyyyMMdd"), half_day)
    revenue = F.when(purchase, cents)
    refund = (
        F.when(purchase & (k % 10 == 0), cents)
        .when(purchase & (k % 10 == 1), F.floor(cents / 2).cast("double"))
        .when(refund_only, (k * 100 + 50).cast("double"))
    )
    shipping = F.when(purchase, (k * 10).cast("double"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))

    def item(i: Column) -> Column:
        n = k * 7 + i * 13
        quantity = 1 + (k + i) % 3
        price = F.floor(cents / (i + 2)).cast("double")
        amount = price * quantity
        refunded = F.when(k % 10 == 0, amount)
        values = {
            "item_id": F.when((k + i) % 17 == 0, "(not set)").otherwise(F.concat(F.lit("I"), (n % 40).cast("string"))),
            "item_name": F.when((k + i) % 19 == 0, "(not set)").otherwise(F.concat(F.lit("Name "), (n % 20).cast("string"))),
            "item_brand": F.when(n % 11 == 0, "").otherwise(F.concat(F.lit("Brand "), (n % 5).cast("string"))),
            "item_variant": F.concat(F.lit("V"), ((k + i) % 3).cast("string")),
            "item_category": F.when(n % 9 == 0, "(not set)").otherwise(F.concat(F.lit("Category "), (n % 4).cast("string"))),
            "promotion_id": F.when(n % 7 == 0, "PROMO").otherwise("(not set)"),
            "promotion_name": _missing(),
            "coupon": F.when((k + i) % 9 == 0, "SAVE").otherwise(""),
            "price": price,
            "quantity": quantity,
            "item_revenue": amount,
            "item_revenue_in_usd": amount,
            "item_refund": refunded,
            "item_refund_in_usd": refunded,
        }
        return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in ITEM.fields])

    item_count = (k % 4).cast("int")
    no_items = F.array().cast(T.ArrayType(ITEM))
    items = (
        F.when(purchase & (item_count > 0), F.transform(F.sequence(F.lit(0), F.greatest(item_count - 1, F.lit(0))), item))
        .when(purchase & (k < 80), no_items)
    )

    def param(key: str, text: Column | None = None, number: Column | None = None) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.struct(
                (text if text is not None else _missing()).cast("string").alias("string_value"),
                (number if number is not None else _missing()).cast("long").alias("int_value"),
            ).alias("value"),
        )

    params = F.array(
        param("session_engaged", text=F.when(k % 3 == 0, "1").otherwise("0")),
        param("ga_session_id", number=F.when(k != 99, F.date_format("day", "yyyyMMdd").cast("long"))),
        param("engagement_time_msec", number=F.when(k % 5 != 0, k * 100)),
        param("campaign", text=F.when(k % 6 != 0, _pick(VISIT_CAMPAIGNS, k))),
        param("medium", text=F.when(k % 7 != 0, _pick(VISIT_MEDIUMS, k))),
        param("source", text=F.when(k % 8 != 0, _pick(VISIT_SOURCES, k))),
    )
    columns = {
        "event_date": F.date_format("day", "yyyyMMdd"),
        "event_timestamp": micros,
        "event_name": F.col("event_type"),
        "user_id": F.when(k % 6 != 5, F.concat(F.lit("u"), user.cast("string"))),
        "user_pseudo_id": F.concat(F.lit("p"), user.cast("string")),
        "event_params": params,
        "ecommerce": F.struct(
            F.when((purchase | refund_only) & (k % 20 != 7), transaction)
            .when(purchase, "(not set)")
            .alias("transaction_id"),
            revenue.alias("purchase_revenue"),
            revenue.alias("purchase_revenue_in_usd"),
            refund.alias("refund_value"),
            refund.alias("refund_value_in_usd"),
            shipping.alias("shipping_value"),
            shipping.alias("shipping_value_in_usd"),
            F.when(purchase, item_count.cast("long")).alias("unique_items"),
        ),
        "items": items,
        "geo": F.struct(
            F.when(user % 13 == 0, "(not set)").otherwise(F.concat(F.lit("Country "), (user % 25).cast("string"))).alias("country"),
            F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("City "), (user % 60).cast("string"))).alias("city"),
        ),
        "device": F.struct(
            F.when(k % 3 == 0, "mobile").when(k % 3 == 1, "desktop").otherwise("(not set)").alias("category"),
            F.concat(F.lit("OS "), (user % 4).cast("string")).alias("operating_system"),
            F.when(user % 2 == 0, "en").otherwise("fr").alias("language"),
        ),
        "traffic_source": F.struct(
            _pick(VISIT_SOURCES, user).alias("source"),
            _pick(VISIT_MEDIUMS, user).alias("medium"),
            F.when(user % 9 != 0, _pick(VISIT_CAMPAIGNS, user)).alias("name"),
        ),
    }
    return source.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def web_frames(spark: SparkSession, directory: str) -> EventFrames:
    return flatten(web_export(spark, directory))


__all__ = ["PARAM", "order_lines", "shop_frames", "table", "web_export", "web_frames"]
