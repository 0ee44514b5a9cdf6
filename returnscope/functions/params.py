"""Access to key/value arrays and to the earliest value of a group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _entry(params: Column, key: str) -> Column:
    return F.get(F.filter(params, lambda p: p["key"] == key), F.lit(0))["value"]


def param_string(params: Column, key: str) -> Column:
    """String value of the first entry with this key, NULL when there is none."""
    return _entry(params, key)["string_value"]


def param_int(params: Column, key: str) -> Column:
    return _entry(params, key)["int_value"]


def earliest(value: Column, at: Column) -> Column:
    """Aggregate: smallest (time, value) pair among non-NULL values.

    The pair form can be merged again with ``min`` over an earlier pre-aggregation; equal
    timestamps are resolved by the value so that the result does not depend on row order.
    """
    return F.min(F.when(value.isNotNull(), F.struct(at.alias("at"), value.alias("value"))))
