"""Schema of the nested web-analytics export and the columns of its flat form."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

PARAM = _struct(key=_S, value=_struct(string_value=_S, int_value=_L))

ECOMMERCE = _struct(
    transaction_id=_S,
    purchase_revenue=_D,
    purchase_revenue_in_usd=_D,
    refund_value=_D,
    refund_value_in_usd=_D,
    shipping_value=_D,
    shipping_value_in_usd=_D,
    unique_items=_L,
)

ITEM = _struct(
    item_id=_S,
    item_name=_S,
    item_brand=_S,
    item_variant=_S,
    item_category=_S,
    promotion_id=_S,
    promotion_name=_S,
    coupon=_S,
    price=_D,
    quantity=_L,
    item_revenue=_D,
    item_revenue_in_usd=_D,
    item_refund=_D,
    item_refund_in_usd=_D,
)

EVENT_SCHEMA = _struct(
    event_date=_S,
    event_timestamp=_L,
    event_name=_S,
    user_id=_S,
    user_pseudo_id=_S,
    event_params=T.ArrayType(PARAM),
    ecommerce=ECOMMERCE,
    items=T.ArrayType(ITEM),
    geo=_struct(country=_S, city=_S),
    device=_struct(category=_S, operating_system=_S, language=_S),
    traffic_source=_struct(source=_S, medium=_S, name=_S),
)

ECOMMERCE_FIELDS = ECOMMERCE.fieldNames()
ITEM_FIELDS = ITEM.fieldNames()
