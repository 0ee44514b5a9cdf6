"""Queries over the event sources: lookups, mappings, aggregates, history, features, assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.base import SOURCES, WEB_RECENT, Query, event_query, table_query
from registry.sql import CHANNEL, WEB, assembled
from returnscope.config import TRANSACTION_KEYS
from returnscope.functions.rates import refund_rate
from returnscope.functions.strings import channel_grouping, clean_string, normalize_string
from returnscope.operators import aggregates as agg
from returnscope.operators import assemble, features, history, mappings
from returnscope.operators import lookups as keys
from returnscope.operators.lookups import Lookups
from returnscope.operators.sparse import unfolded
from returnscope.plans.features import build_features, no_stage, stage
from returnscope.plans.run import Place, forget, prediction_run, read_result, trained_segments, training_log, training_run
from returnscope.sources.bindings import web_export
from returnscope.sources.export import EventFrames, explode_items, read_export, store_export
from returnscope.sources.tables import drop_tables, path_exists, read_table, stage_path, table_location, write_table

RATE = 6
# Jobs that read the flat frames many times.
STAGED = (
    "assemble", "segment", "pivot", "event_grid", "traffic_rates", "prefer", "customer_type",
    "basket_description", "past_product_history", "brand_category_rates", "past_user_item", "same_item_summary", "same_variant_summary",
)
# The lists of a basket beside its description.
BASKET_SQL = f"""
    SELECT * FROM f_basket JOIN (
        SELECT transaction_id, transaction_date, {", ".join(f"string_agg({c}, ',' ORDER BY {c}) AS {n}" for n, c in features.BASKET_LISTS.items())}
        FROM istats GROUP BY 1, 2) USING (transaction_id, transaction_date)"""
VOCABULARY = ["click", "error", "purchase", "signup", "view"]


def _rates(*names: str) -> dict[str, int]:
    return {n: RATE for n in names}


GLOBAL_RATES = _rates("past_grand_avg_refund_amt_proportion", "past_grand_avg_refund_rate")
USER_RATES = _rates("calculated_past_user_refund_rate", "calculated_past_user_refund_amt_proportion")
USER_ITEM_RATES = _rates("calculated_past_user_item_refund_rate", "calculated_past_user_item_refund_amt_proportion")
PRODUCT_RATES = _rates("calculated_past_product_refund_rate", "calculated_past_product_refund_amt_proportion")
ROLLING_RATES = _rates(*[f"past_{n}_days_refund_proportion" for n in (3, 7, 30)])
BRAND_RATES = _rates(*[f"calculated_past_{c}_refund_{k}" for c in ("brand", "category") for k in ("rate", "amt_proportion")])
DEMO_RATES = _rates(
    *[
        f"calculated_past_{c}_refund_{k}"
        for c in ("country", "city", "device_category", "device_operating_system", "device_language")
        for k in ("rate", "amt_proportion")
    ]
)
TRAFFIC_RATES = _rates(
    *[f"calculated_past_traffic_{c}_refund_{k}" for c in ("source", "medium", "campaign") for k in ("rate", "amt_proportion")]
)
BASKET_DIGITS = {
    **PRODUCT_RATES,
    "avg_price": 2,
    "std_price": 2,
    "std_item_revenue": 2,
    "avg_item_revenue": 2,
    "std_quantity": RATE,
    "avg_quantity": RATE,
    "avg_same_item_item_quantity": RATE,
    "avg_same_item_variant_quantity": RATE,
}
SESSION_DIGITS = {"session_length_in_seconds": 3, "engagement_time_seconds": 3}
WIDE_DIGITS = {
    **{k: v for k, v in BASKET_DIGITS.items() if k not in ("std_quantity", "avg_quantity")},
    "std_item_quantity": RATE,
    "avg_item_quantity": RATE,
    **USER_RATES,
    **USER_ITEM_RATES,
    **ROLLING_RATES,
    **BRAND_RATES,
    **DEMO_RATES,
    **TRAFFIC_RATES,
    "refund_proportion": RATE,
    "session_length_in_seconds": 3,
    "web_traffic_engagement_time_seconds": 3,
}


def _stats(f: EventFrames, l: Lookups) -> DataFrame:
    return agg.transaction_item_stats(f, l)


def _prior(f: EventFrames, l: Lookups) -> DataFrame:
    return history.past_global_history(f, l)


def _user(identity: str):
    return lambda f, l: features.past_identity(
        mappings.transaction_identity(f, l, identity), agg.identity_daily(f, l, identity), _prior(f, l), identity
    )


def _user_item(identity: str):
    return lambda f, l: features.past_identity_item(
        mappings.transaction_identity_item(f, l, identity), agg.identity_item_daily(f, l, identity), _prior(f, l), identity
    )


def _product(f, l, stats=None):
    stats = stats if stats is not None else stage(_stats(f, l), "item_stats")
    return features.past_product_history(stats, agg.product_daily(f, l))


def _basket(f, l):
    stats = stage(_stats(f, l), "item_stats")
    return features.basket_description(stats, _product(f, l, stats), _prior(f, l))


def _sessions(f, l):
    return features.session_features(mappings.transaction_session(f, l), agg.session_traffic(agg.session_event_facts(f, l)))


def _web_events(f, l):
    return features.web_events(mappings.transaction_session(f, l), agg.session_events(agg.session_event_facts(f, l)))


def _demographics(f, l):
    return features.transaction_demographics(
        l,
        mappings.transaction_identity(f, l, "user_id"),
        agg.demographics(f, l, "user_id"),
        mappings.transaction_identity(f, l, "user_pseudo_id"),
        agg.demographics(f, l, "user_pseudo_id"),
    )


def _preferred(f, l):
    """Purchase history by user, filled from the pseudo-user's."""
    return assemble.prefer_user_over_pseudo(
        l.transactions, _user("user_id")(f, l), _user("user_pseudo_id")(f, l), assemble.USER_HISTORY
    )


def _vocabulary_of(f: EventFrames, window) -> list[str]:
    """Event names of a training run, here over the whole source."""
    return features.event_vocabulary(_web_events(f, Lookups(f, window)))


def _sparse_pairs(f: EventFrames, l: Lookups) -> DataFrame:
    """Sparse rows over the dictionary of the whole source, unfolded into their entries."""
    names = stage(features.event_dictionary(_web_events(f, Lookups(f, SOURCES["web"].window))), "event_dictionary")
    rows = features.sparse_events(stage(_web_events(f, l), "web_events"), names)
    return unfolded(rows, names, TRANSACTION_KEYS, "event_positions", features.EVENT_MEASURES)


def _sparse_wide(f: EventFrames, l: Lookups) -> DataFrame:
    """Feature rows with their events in arrays, a row per entry."""
    run = build_features(f, l.window, keep=stage, sparse=True)
    others = [c for c in run.rows.columns if c not in {"event_positions", *features.EVENT_MEASURES}]
    return unfolded(stage(run.rows, "feature_rows"), run.dictionary, others, "event_positions", features.EVENT_MEASURES)


def _wide(source: str, vocabulary: list[str] | None = None):
    def rows(f: EventFrames, l: Lookups) -> DataFrame:
        names = vocabulary
        if names is None:
            names = _vocabulary_of(f, SOURCES["web"].window) if source.startswith("web") else []
        return build_features(f, l.window, vocabulary=names, keep=stage).rows

    return rows


def _segment_sql(kind: str, drop: list[str]) -> str:
    return (
        f"SELECT * EXCLUDE ({', '.join(['customer_type', *drop])}) FROM ({assembled(VOCABULARY)}) "
        f"WHERE customer_type = '{kind}' AND past_30_days_transaction_value IS NOT NULL"
    )


PIVOT_SQL = {
    m: "SELECT transaction_id, transaction_date"
    + "".join(f", {cast.format(f'sum(CASE WHEN event_name = {v!r} THEN {m} ELSE 0 END)')} AS {m}_{v}" for v in VOCABULARY)
    + " FROM f_events GROUP BY 1, 2"
    for m, cast in (("event_count", "CAST({} AS BIGINT)"), ("event_length_in_seconds", "{}"))
}
_ENTRIES = "SELECT * FROM f_events WHERE event_name IS NOT NULL AND (event_count IS NOT NULL OR event_length_in_seconds IS NOT NULL)"
SPARSE_SQL = f"SELECT transaction_id, transaction_date, event_name, event_count, event_length_in_seconds FROM ({_ENTRIES})"
SPARSE_WIDE_SQL = f"""
    SELECT w.*, e.event_name, e.event_count, e.event_length_in_seconds FROM ({assembled([])}) w
    JOIN ({_ENTRIES}) e ON e.transaction_id = w.transaction_id AND e.transaction_date = w.transaction_date"""
GRID_SQL = f"""
    SELECT k.transaction_id, k.transaction_date, v.event_name, coalesce(o.event_length_in_seconds, 0) AS event_length_in_seconds,
           coalesce(o.event_count, 0) AS event_count
    FROM (SELECT DISTINCT transaction_id, transaction_date FROM f_events) k
    CROSS JOIN (SELECT unnest({VOCABULARY}) AS event_name) v
    LEFT JOIN f_events o ON o.transaction_id = k.transaction_id AND o.transaction_date = k.transaction_date AND o.event_name = v.event_name"""
PREFERRED_SQL = f"""
    SELECT t.transaction_id, t.transaction_date, {", ".join(f"coalesce(u.{c}, p.{c}, 0) AS {c}" for c in assemble.USER_HISTORY)}
    FROM l_tx t LEFT JOIN f_user u ON u.transaction_id = t.transaction_id AND u.transaction_date = t.transaction_date
    LEFT JOIN f_pseudo p ON p.transaction_id = t.transaction_id AND p.transaction_date = t.transaction_date"""


def _event_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    def add(name, source, build, body, digits=None, dates=("transaction_date",)):
        q[name] = event_query(source, build, body, digits, dates, staged=name.startswith(STAGED))

    # Lookups.
    valid = ["event_day", "transaction_id", "user_id", "user_pseudo_id", "purchase_revenue", "refund_value"]
    add("valid_transactions", "web", lambda f, l: f.events.transform(keys.valid_transactions(l.window.end)).select(*valid), f"SELECT {', '.join(valid)} FROM valid", dates=("event_day",))
    add("transaction_lookup", "web", lambda f, l: l.transactions, "SELECT * FROM l_tx")
    add("transaction_date_lookup", "web_recent", lambda f, l: l.dates, "SELECT * FROM l_date")
    add("user_lookup", "web", lambda f, l: l.users, "SELECT * FROM l_user", dates=())
    add("pseudo_user_lookup", "web", lambda f, l: l.pseudo_users, "SELECT * FROM l_pseudo", dates=())
    add("session_lookup", "web_recent", lambda f, l: l.sessions, "SELECT * FROM l_sess", dates=())
    add("item_lookup", "web", lambda f, l: l.items, "SELECT * FROM l_item", dates=())

    # Mappings.
    add("map_txn_user", "web", lambda f, l: mappings.transaction_identity(f, l, "user_id"), "SELECT * FROM m_user")
    add("map_txn_pseudo_user", "web", lambda f, l: mappings.transaction_identity(f, l, "user_pseudo_id"), "SELECT * FROM m_pseudo")
    add("map_txn_user_item", "web", lambda f, l: mappings.transaction_identity_item(f, l, "user_id"), "SELECT * FROM m_user_item")
    add("map_txn_pseudo_user_item", "web", lambda f, l: mappings.transaction_identity_item(f, l, "user_pseudo_id"), "SELECT * FROM m_pseudo_item")
    add("map_txn_session", "web", mappings.transaction_session, "SELECT * FROM m_sess")

    # First-level aggregates, on both sources.
    for source, suffix in (("shop", ""), ("web", "_web")):
        add(f"txn_totals{suffix}", source, agg.transaction_totals, "SELECT * FROM totals")
        add(f"daily_totals{suffix}", source, agg.daily_totals, "SELECT * FROM daily")
        add(f"txn_item_stats{suffix}", source, _stats, "SELECT * FROM istats", {"price": 4})
        add(f"product_daily{suffix}", source, agg.product_daily, "SELECT * FROM pdaily")
        add(f"user_daily{suffix}", source, lambda f, l: agg.identity_daily(f, l, "user_id"), "SELECT * FROM udaily")
        add(f"user_item_daily{suffix}", source, lambda f, l: agg.identity_item_daily(f, l, "user_id"), "SELECT * FROM uidaily")
        add(f"past_global_history{suffix}", source, history.past_global_history, "SELECT * FROM overall", GLOBAL_RATES)
        add(f"demographics_user{suffix}", source, lambda f, l: agg.demographics(f, l, "user_id"), "SELECT * FROM demo_u", dates=())
        add(f"targets{suffix}", source, lambda f, l: features.targets(agg.transaction_totals(f, l)), "SELECT * FROM f_targets", {"refund_proportion": RATE})
        add(f"same_item_summary{suffix}", source, lambda f, l: features.same_item_summary(_stats(f, l)), "SELECT * FROM f_same_item", {"avg_same_item_item_quantity": RATE})
        add(f"same_variant_summary{suffix}", source, lambda f, l: features.same_variant_summary(_stats(f, l)), "SELECT * FROM f_same_variant", {"avg_same_item_variant_quantity": RATE})
        add(f"past_product_history{suffix}", source, _product, "SELECT * FROM f_product")
        if source == "shop":
            add("basket_description", source, _basket, BASKET_SQL, BASKET_DIGITS)
        else:
            add("basket_description_web", source, lambda f, l: _basket(f, l).drop(*features.BASKET_LISTS), "SELECT * FROM f_basket", BASKET_DIGITS)
        add(f"rolling_refunds{suffix}", source, history.rolling_refunds, "SELECT * FROM f_rolling", ROLLING_RATES)
        add(f"past_user{suffix}", source, _user("user_id"), "SELECT * FROM f_user", USER_RATES)
        add(f"past_user_item{suffix}", source, _user_item("user_id"), "SELECT * FROM f_user_item", USER_ITEM_RATES)
        add(f"demographic_rates{suffix}", source, lambda f, l: features.demographic_rates(stage(_demographics(f, l), "demographics"), f, l, _prior(f, l)), "SELECT * FROM f_demo", DEMO_RATES)
        add(f"brand_category_rates{suffix}", source, lambda f, l: features.brand_category_rates(stage(_stats(f, l), "item_stats"), f, l, _prior(f, l)), "SELECT * FROM f_brand", BRAND_RATES)
        for level in history.VISITOR_LEVELS:
            add(f"past_by_{level}{suffix}", source, lambda f, l, level=level: history.past_by_level(f, l, level), f"SELECT * FROM past_{level}")
        for level in history.ITEM_LEVELS:
            add(f"past_by_{level.removeprefix('item_')}{suffix}", source, lambda f, l, level=level: history.past_by_level(f, l, level), f"SELECT * FROM past_{level}")

    # What only the click stream has.
    add("pseudo_user_daily", "web", lambda f, l: agg.identity_daily(f, l, "user_pseudo_id"), "SELECT * FROM pudaily")
    add("pseudo_user_item_daily", "web", lambda f, l: agg.identity_item_daily(f, l, "user_pseudo_id"), "SELECT * FROM puidaily")
    add("demographics_pseudo_user", "web", lambda f, l: agg.demographics(f, l, "user_pseudo_id"), "SELECT * FROM demo_p", dates=())
    for level in history.TRAFFIC_LEVELS:
        add(f"past_by_{level}", "web", lambda f, l, level=level: history.past_by_level(f, l, level), f"SELECT * FROM past_{level}")
    add("session_traffic", "web", lambda f, l: agg.session_traffic(agg.session_event_facts(f, l)), "SELECT * FROM sess", SESSION_DIGITS, ())
    add("session_events", "web", lambda f, l: agg.session_events(agg.session_event_facts(f, l)), "SELECT * FROM sev", {"event_length_in_seconds": 3}, ())
    add("session_features", "web", _sessions, "SELECT * FROM f_session", SESSION_DIGITS)
    add("web_events", "web", _web_events, "SELECT * FROM f_events", {"event_length_in_seconds": 3})
    add("pivot_event_count", "web", lambda f, l: features.pivot_events(_web_events(f, l), "event_count", _vocabulary_of(f, l.window)), PIVOT_SQL["event_count"])
    add("pivot_event_length", "web", lambda f, l: features.pivot_events(_web_events(f, l), "event_length_in_seconds", _vocabulary_of(f, l.window)), PIVOT_SQL["event_length_in_seconds"], {f"event_length_in_seconds_{v}": 3 for v in VOCABULARY})
    add("sparse_event_counts", "web", _sparse_pairs, SPARSE_SQL, {"event_length_in_seconds": 3})
    add("sparse_event_counts_recent", "web_recent", _sparse_pairs, SPARSE_SQL, {"event_length_in_seconds": 3})
    add("event_grid", "web_recent", lambda f, l: features.event_grid(_web_events(f, l), _vocabulary_of(f, SOURCES["web"].window)), GRID_SQL, {"event_length_in_seconds": 3})
    add("past_pseudo_user", "web", _user("user_pseudo_id"), "SELECT * FROM f_pseudo", USER_RATES)
    add("past_pseudo_user_item", "web", _user_item("user_pseudo_id"), "SELECT * FROM f_pseudo_item", USER_ITEM_RATES)
    add("traffic_rates", "web", lambda f, l: features.traffic_rates(stage(_sessions(f, l), "sessions"), f, l, _prior(f, l)), "SELECT * FROM f_traffic", TRAFFIC_RATES)
    add("prefer_user_over_pseudo", "web", _preferred, PREFERRED_SQL, USER_RATES)
    add("basket_lists", "shop", lambda f, l: features.basket_lists(_stats(f, l)), "SELECT transaction_id, transaction_date, " + ", ".join(f"string_agg({c}, ',' ORDER BY {c}) AS {n}" for n, c in features.BASKET_LISTS.items()) + " FROM istats GROUP BY 1, 2")

    # Prediction-window variants: transactions of the last days, history from before them.
    add("past_user_recent", "shop_recent", _user("user_id"), "SELECT * FROM f_user", USER_RATES)
    add("past_user_item_recent", "web_recent", _user_item("user_id"), "SELECT * FROM f_user_item", USER_ITEM_RATES)
    add("past_by_country_recent", "shop_recent", lambda f, l: history.past_by_level(f, l, "country"), "SELECT * FROM past_country")
    add("past_by_source_recent", "web_recent", lambda f, l: history.past_by_level(f, l, "source"), "SELECT * FROM past_source")
    add("session_features_recent", "web_recent", _sessions, "SELECT * FROM f_session", SESSION_DIGITS)

    # The wide row and what is cut from it.
    wide_digits = {**WIDE_DIGITS, **{f"event_length_in_seconds_{v}": 3 for v in VOCABULARY}}
    add("assemble_features", "web", _wide("web"), assembled(VOCABULARY), wide_digits)
    add("assemble_features_recent", "web_recent", _wide("web_recent"), assembled(VOCABULARY), wide_digits)
    add("assemble_features_shop", "shop", _wide("shop"), assembled([]), WIDE_DIGITS)
    add("assemble_features_sparse", "web", _sparse_wide, SPARSE_WIDE_SQL, {**WIDE_DIGITS, "event_length_in_seconds": 3})
    add("customer_type", "web", lambda f, l: _preferred(f, l).select(*TRANSACTION_KEYS, assemble.customer_type(F.col("past_user_purchase_revenue")).alias("customer_type")), f"SELECT transaction_id, transaction_date, CASE WHEN past_user_purchase_revenue = 0 THEN 'first time purchase' ELSE 'existing customer transaction' END AS customer_type FROM ({PREFERRED_SQL})")
    add("segment_existing", "web", lambda f, l: assemble.existing_customers(_wide("web")(f, l)), _segment_sql("existing customer transaction", []), wide_digits)
    first_digits = {k: v for k, v in wide_digits.items() if k not in assemble.PAST_USER_COLUMNS}
    add("segment_first_purchase", "web", lambda f, l: assemble.first_time_purchases(_wide("web")(f, l)), _segment_sql("first time purchase", assemble.PAST_USER_COLUMNS), first_digits)

    # Functions.
    add("channel_grouping", "web", lambda f, l: f.events.select("session_id", "event_timestamp", channel_grouping(F.col("visit_source"), F.col("visit_medium"), F.col("visit_campaign")).alias("channel")), f"SELECT session_id, event_timestamp, {CHANNEL} AS channel FROM ev", dates=())
    add("channel_grouping_params", "web", lambda f, l: f.events.select("event_timestamp", channel_grouping(F.col("source"), F.col("medium"), F.col("campaign")).alias("channel")), f"SELECT event_timestamp, {CHANNEL.replace('visit_', '')} AS channel FROM ev", dates=())
    add("normalize_string", "web", lambda f, l: f.events.select("event_timestamp", *[normalize_string(F.col(c)).alias(c) for c in ("country", "city")]), "SELECT event_timestamp, CASE WHEN country IN ('(not set)', '') THEN NULL ELSE country END AS country, CASE WHEN city IN ('(not set)', '') THEN NULL ELSE city END AS city FROM ev", dates=())
    add("clean_string", "web", lambda f, l: f.events.select("event_timestamp", *[clean_string(F.col(c)).alias(c) for c in ("campaign", "medium")]), "SELECT event_timestamp, CASE WHEN campaign IN ('(none)', '(not set)', '(data deleted)') THEN 'unknown' ELSE campaign END AS campaign, CASE WHEN medium IN ('(none)', '(not set)', '(data deleted)') THEN 'unknown' ELSE medium END AS medium FROM ev", dates=())
    add(
        "refund_rate",
        "shop",
        lambda f, l: agg.identity_daily(f, l, "user_id")
        .groupBy("user_id")
        .agg(refund_rate(F.col("refund_value"), F.lit(0.25), F.col("purchase_revenue")).alias("rate")),
        "SELECT user_id, (sum(refund_value) + avg(0.25) * 0.2) / nullif(sum(purchase_revenue) + 0.2, 0) AS rate FROM udaily GROUP BY 1",
        {"rate": RATE},
        (),
    )
    add("first_by_time", "web", lambda f, l: agg.session_traffic(agg.session_event_facts(f, l)).select("session_id", "campaign", "medium", "source"), "SELECT session_id, campaign, medium, source FROM sess", dates=())
    add("param_lookup", "web", lambda f, l: f.events.select("event_timestamp", "session_id", "session_engaged", "engagement_time_msec", "campaign"), "SELECT event_timestamp, session_id, session_engaged, engagement_time_msec, campaign FROM ev", dates=())
    return q


_trained: dict[tuple[str, str], Place] = {}


def _export_queries() -> dict[str, Query]:
    """Scans of the nested export itself."""
    def flat(export: DataFrame) -> DataFrame:
        return export.select(
            "event_date",
            "event_timestamp",
            "event_name",
            "user_id",
            "user_pseudo_id",
            F.col("ecommerce.transaction_id").alias("transaction_id"),
            F.col("geo.country").alias("country"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("item_rows"),
        )

    scan = """
        SELECT strftime(e.event_day, '%Y%m%d') AS event_date, e.event_timestamp, e.event_name, e.user_id, e.user_pseudo_id,
               e.transaction_id, e.country, CASE WHEN e.event_name = 'purchase' THEN e.unique_items ELSE 0 END AS item_rows
        FROM ev e"""
    def items(export: DataFrame) -> DataFrame:
        columns = ("item_id", "item_name", "quantity", "item_revenue")
        return explode_items(export).select("event_date", "event_timestamp", *[F.col(f"item.{c}").alias(c) for c in columns])

    def windowed(s, d):
        """Stored with a folder per day, and read for the days of the window only."""
        path = stage_path(s, "export")
        store_export(web_export(s, d), path)
        return flat(read_export(s, path, WEB_RECENT.start, WEB_RECENT.end))

    def trained(s: SparkSession, d: str) -> Place:
        """A run over the whole window, trained once a session for each folder of tables."""
        run = (s.sparkContext.applicationId, d)
        if run not in _trained:
            place = Place(stage_path(s, "models"), f"returnscope_run{len(_trained)}")
            forget(s, place)
            training_run(SOURCES["web"].frames(s, d), SOURCES["web"].window, place)
            _trained[run] = place
        return _trained[run]

    def ready(segment: str):
        """Keys, label and split of a segment's model-ready rows, read back by name."""
        def run(s, d):
            return read_result(s, trained(s, d), segment, "refund_value", "ml_ready").select(*TRANSACTION_KEYS, "refund_value", "train_test")

        return run

    def stored(s, d):
        """Split metrics and tiers of both segments, read back by name."""
        place, parts = trained(s, d), []
        for segment in trained_segments(s, place):
            tiers, metrics = (read_result(s, place, segment, "refund_value", kind) for kind in ("tiers", "split_metrics"))
            parts.append(tiers.join(metrics, "train_test").withColumn("segment", F.lit(segment)))
        return reduce(DataFrame.unionByName, parts)

    def daily(s, d):
        """Trained on the whole window, predicted for its last days."""
        return prediction_run(SOURCES["web_recent"].frames(s, d), SOURCES["web_recent"].window, trained(s, d))

    def cleanup(s, d):
        """Write the event table and an intermediate, drop all but the kept vocabulary table."""
        frames = SOURCES["web"].frames(s, d)
        lookups = Lookups(frames, SOURCES["web"].window)
        kept, gone = "returnscope_training_web_events", "returnscope_training_transaction_lookup"
        write_table(_web_events(frames, lookups), kept, path=stage_path(s, kept))
        write_table(lookups.transactions, gone, path=stage_path(s, gone))
        files = table_location(s, gone)
        if drop_tables(s, [kept, gone], keep=[kept]) != [gone] or path_exists(s, files):
            raise RuntimeError(f"{gone} or its files are still there")
        return read_table(s, kept)

    return {
        "scan_events": table_query(lambda s, d: flat(web_export(s, d)), scan, blocks=WEB),
        "windowed_scan": table_query(windowed, f"{scan} WHERE e.event_day BETWEEN DATE '{WEB_RECENT.start}' AND DATE '{WEB_RECENT.end}'", blocks=WEB),
        "explode_items": table_query(
            lambda s, d: items(web_export(s, d)),
            """SELECT strftime(c.day, '%Y%m%d') AS event_date, epoch_us(c.ts) AS event_timestamp,
                      CASE WHEN (k + i) % 17 = 0 THEN '(not set)' ELSE 'I' || ((k * 7 + i * 13) % 40) END AS item_id,
                      CASE WHEN (k + i) % 19 = 0 THEN '(not set)' ELSE 'Name ' || ((k * 7 + i * 13) % 20) END AS item_name,
                      1 + (k + i) % 3 AS quantity, floor(cents / (i + 2)) * (1 + (k + i) % 3) AS item_revenue
               FROM clicks c JOIN (SELECT unnest(range(3)) AS i) s ON s.i < c.k % 4 WHERE c.purchase""",
            blocks=WEB,
        ),
        "training_log": table_query(lambda s, d: training_log(s, trained(s, d)), None),
        "ml_ready_existing": table_query(ready("existing"), None),
        "ml_ready_first_purchase": table_query(ready("first_purchase"), None),
        "stored_results": table_query(stored, None),
        "daily_prediction": table_query(daily, None),
        "cleanup": Query(cleanup_rows(cleanup), event_query("web", _web_events, "SELECT * FROM f_events", {"event_length_in_seconds": 3}).sql),
    }


def cleanup_rows(run):
    from registry.base import comparable

    return lambda s, d: comparable(run(s, d), {"event_length_in_seconds": 3})


def queries() -> dict[str, Query]:
    return {**_event_queries(), **_export_queries()}


__all__ = ["no_stage", "queries"]
