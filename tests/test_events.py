"""Hand-computed cases on a small nested export."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from returnscope.config import RunWindow
from returnscope.operators import aggregates as agg
from returnscope.operators import features, history, mappings
from returnscope.operators.lookups import Lookups
from returnscope.plans.features import build_features
from returnscope.sources.export import explode_items, flatten, read_export
from returnscope.sources.schema import EVENT_SCHEMA

WINDOW = RunWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 31))


def event(day, name="purchase", at=0, user=None, pseudo="p1", txn=None, revenue=None, refund=None, items=None, session=None, **params):
    entries = [("ga_session_id", (None, session))] if session is not None else []
    entries += [(k, (v, None) if isinstance(v, str) or v is None else (None, v)) for k, v in params.items()]
    return (
        f"202401{day:02d}", at, name, user, pseudo, entries or None,
        (txn, revenue, revenue, refund, refund, 5.0, 5.0, len(items or [])),
        items, ("DE", ""), ("mobile", "(not set)", "en"), ("google", "organic", None),
    )


def item(name, revenue=10.0, refund=None, item_id=None, brand="B", quantity=1, coupon=""):
    return (item_id or f"id-{name}", name, brand, "v", "(not set)", "(not set)", None, coupon, 10.0, quantity, revenue, revenue, refund, refund)


EVENTS = [
    event(1, user="u1", txn="a", revenue=100.0, items=[item("shoe"), item("sock", coupon="X")], session=1, at=1_000_000, campaign=None),
    event(1, "view", user="u1", session=1, at=3_000_000, campaign="spring", session_engaged="1", engagement_time_msec=1500),
    # A gap, then two purchases of one user on one day.
    event(4, user="u1", txn="b", revenue=50.0, refund=50.0, items=[item("shoe", 50.0, 50.0)], session=2, at=10_000_000),
    event(4, user="u1", txn="c", revenue=30.0, items=[], session=3, at=20_000_000),
    event(4, "scroll", user="u1", txn="c", session=4, at=21_000_000),
    # A refund on a later date, and one without revenue.
    event(6, "refund", user="u1", txn="a", refund=40.0, at=30_000_000),
    event(8, user="u1", txn="d", revenue=10.0, items=None, session=5, at=40_000_000),
    event(9, user=None, pseudo="p2", txn="e", revenue=20.0, items=[item("(not set)"), item("hat", item_id="(not set)")], session=6, at=50_000_000),
    event(9, user="u9", txn="(not set)", revenue=20.0, items=[item("shoe")], session=7, at=60_000_000),
]


@pytest.fixture(scope="module")
def export(spark):
    return spark.createDataFrame(EVENTS, EVENT_SCHEMA)


@pytest.fixture(scope="module")
def frames(export):
    return flatten(export)


@pytest.fixture(scope="module")
def lookups(frames):
    return Lookups(frames, WINDOW)


def keyed(df, *columns):
    return {r.transaction_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_lookups(lookups):
    assert {r.transaction_id for r in lookups.transactions.collect()} == {"a", "b", "c", "d", "e"}
    assert {r.user_id for r in lookups.users.collect()} == {"u1"}
    assert {r.item_name for r in lookups.items.collect()} == {"shoe", "sock"}


def test_explode_drops_missing_and_empty_lists(export):
    assert explode_items(export).count() == 6


def test_targets_ignore_refunds_of_later_days(frames, lookups):
    got = keyed(features.targets(agg.transaction_totals(frames, lookups)), "purchase_revenue", "refund_value", "refund_flag")
    assert got["a"] == (100.0, None, 0) and got["b"] == (50.0, 50.0, 1)
    daily = {r.transaction_date.day: r.refund_value for r in agg.daily_totals(frames, lookups).collect()}
    assert 6 not in daily and daily[4] == 50.0


def test_user_history(frames, lookups):
    prior = history.past_global_history(frames, lookups)
    rows = features.past_identity(
        mappings.transaction_identity(frames, lookups, "user_id"), agg.identity_daily(frames, lookups, "user_id"), prior, "user_id"
    )
    got = keyed(rows, "past_user_purchase_revenue", "past_user_refund_value", "past_user_refund_count", "past_user_transaction_count")
    assert got["a"] == (0.0, None, 0, 1)  # no history counts as one day
    assert got["b"] == got["c"] == (200.0, None, 0, 2)  # two transactions that day count history twice
    assert got["d"] == (180.0, 90.0, 2, 3)  # days 1, 4 and 6; the refund-only day is part of it
    assert "e" not in got
    rates = keyed(rows, "calculated_past_user_refund_rate")
    assert rates["a"] == (None,) and rates["d"] == (pytest.approx((2 + 0.2 * 1 / 3) / 3.2),)


def test_pseudo_user_history_fills_missing_refunds(frames, lookups):
    prior = history.past_global_history(frames, lookups)
    rows = features.past_identity(
        mappings.transaction_identity(frames, lookups, "user_pseudo_id"),
        agg.identity_daily(frames, lookups, "user_pseudo_id"), prior, "user_pseudo_id",
    )
    assert keyed(rows, "past_user_refund_value")["a"] == (0.0,)


def test_rolling_counts_days_with_transactions(frames, lookups):
    rows = {r.transaction_date.day: r for r in history.rolling_refunds(frames, lookups).collect()}
    assert rows[1].past_3_days_transaction_value is None
    assert rows[8].past_3_days_transaction_value == 180.0
    calendar = {r.transaction_date.day: r for r in history.rolling_refunds(frames, lookups, calendar_days=True).collect()}
    assert calendar[8].past_3_days_transaction_value is None and calendar[8].past_7_days_transaction_value == 180.0


def test_level_history_matches_the_inequality_join(frames, lookups):
    got = {(r.transaction_date.day, r.country): r.past_trans_count for r in history.past_by_level(frames, lookups, "country").collect()}
    assert got == {(1, None): 0, (4, "DE"): 1, (8, "DE"): 3, (9, "DE"): 4}
    cities = {(r.transaction_date.day, r.city) for r in history.past_by_level(frames, lookups, "city").collect()}
    assert cities == {(1, None), (4, None), (8, None), (9, None)}


def test_sessions(frames, lookups):
    facts = agg.session_event_facts(frames, lookups)
    row = next(r for r in agg.session_traffic(facts).collect() if r.session_id == "p1_1")
    assert (row.session_length_in_seconds, row.engaged_sessions, row.engagement_time_seconds, row.campaign) == (2.0, 1, 1.5, "spring")
    assert row.channel_grouping_user == "Organic Search"
    sessions = {(r.transaction_id, r.session_id) for r in mappings.transaction_session(frames, lookups).collect()}
    # A session without a purchase of its own is not a known session.
    assert ("c", "p1_3") in sessions and ("c", "p1_4") not in sessions


def test_vocabulary_columns(spark, frames, lookups):
    observed = features.web_events(mappings.transaction_session(frames, lookups), agg.session_events(agg.session_event_facts(frames, lookups)))
    assert features.event_vocabulary(observed) == ["purchase", "view"]
    # A name only training knew stays a column; one that training did not know does not appear.
    wide = features.pivot_events(observed, "event_count", ["login", "purchase"])
    assert wide.columns[2:] == ["event_count_login", "event_count_purchase"]
    assert keyed(wide, "event_count_login", "event_count_purchase")["a"] == (0, 1)
    grid = features.event_grid(observed, ["login", "purchase"])
    assert grid.count() == 2 * wide.count() and grid.filter("event_name = 'login'").agg(F.sum("event_count")).first()[0] == 0


def test_item_stats(frames, lookups):
    rows = {(r.transaction_id, r.item_id): r for r in agg.transaction_item_stats(frames, lookups).collect()}
    assert set(rows) == {("a", "id-shoe"), ("a", "id-sock"), ("b", "id-shoe")}
    assert rows["a", "id-sock"].discounted_product_flag and not rows["a", "id-shoe"].discounted_product_flag
    assert rows["a", "id-shoe"].item_category == "unknown"
    lists = keyed(features.basket_lists(agg.transaction_item_stats(frames, lookups)), "item_names")
    assert lists["a"] == ("shoe,sock",)


def test_a_basket_description_lists_its_items(frames, lookups):
    """All four lists stand beside the counts, with a value as often as the basket holds it, in order."""
    stats, prior = agg.transaction_item_stats(frames, lookups), history.past_global_history(frames, lookups)
    described = features.basket_description(stats, features.past_product_history(stats, agg.product_daily(frames, lookups)), prior)
    rows = keyed(described, "item_brands", "item_names", "item_variants", "item_categories", "unique_item_brand_count", "unique_item_category_count")
    assert rows == {"a": ("B,B", "shoe,sock", "v,v", "unknown,unknown", 1, 1), "b": ("B", "shoe", "v", "unknown", 1, 1)}


def test_assembly_keeps_one_row_per_transaction(frames):
    run = build_features(frames, WINDOW)
    rows = keyed(run.rows, "past_user_transaction_count", "customer_type", "item_count", "event_count_purchase")
    assert len(rows) == run.rows.count() == 5
    assert rows["a"] == (1, "first time purchase", 2, 1)
    assert rows["d"] == (3, "existing customer transaction", 0, 1)
    # Without a user the pseudo-user's count is taken.
    assert rows["e"][0] == 1


def test_assembly_broadcasts_no_table_of_transactions(frames):
    plan = build_features(frames, WINDOW).rows._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [transaction_id" in line and "LeftOuter" in line]
    assert len(joins) >= 8 and not any("Broadcast" in line for line in joins)


def test_scan_is_pruned(spark, export, tmp_path):
    path = str(tmp_path / "export")
    export.write.partitionBy("event_date").parquet(path)
    days = read_export(spark, path, dt.date(2024, 1, 4), dt.date(2024, 1, 6))
    assert days.count() == 4
    plan = flatten(days).events.select("event_day", "purchase_revenue")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<ecommerce:struct<purchase_revenue:double>>" in plan


def test_a_stored_export_is_read_for_its_days_only(spark, tmp_path):
    """Whole days are pruned by folder: neither their files nor their rows are read."""
    from returnscope.sources.bindings import web_export
    from returnscope.sources.export import store_export

    path, raw = str(tmp_path / "export"), web_export(spark, "/root/testdata/sf0.001")
    store_export(raw, path)
    stored = read_export(spark, path)
    assert stored.select("event_timestamp", "user_id").exceptAll(raw.select("event_timestamp", "user_id")).count() == 0
    assert stored.count() == raw.count()
    some = read_export(spark, path, dt.date(2024, 1, 4), dt.date(2024, 1, 6))
    assert {r[0] for r in some.select("event_date").distinct().collect()} == {"20240104", "20240105", "20240106"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan.split("PartitionFilters")[1].split("]")[0]
