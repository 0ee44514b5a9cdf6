"""From flat event frames to the feature row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from returnscope.config import RunWindow
from returnscope.operators import aggregates, features, history, mappings
from returnscope.operators.assemble import assemble_features
from returnscope.operators.lookups import Lookups
from returnscope.sources.export import EventFrames
from returnscope.sources.tables import no_stage, side_by_side, stage

Stage = Callable[[DataFrame, str], DataFrame]

IDENTITIES = {"user_id": "user", "user_pseudo_id": "pseudo_user"}


@dataclass(frozen=True)
class FeatureRun:
    """Feature rows of a run and the event names that shaped them: their list, or with sparse events their dictionary."""

    rows: DataFrame
    vocabulary: list[str]
    dictionary: DataFrame | None = None


def stage_frames(frames: EventFrames) -> EventFrames:
    """Write each flat frame when it is first used, so that the nested export is parsed once.

    Worth it whenever a feature run follows: some twenty operators read these frames, each with a
    handful of columns.
    """
    return frames.kept(stage)


def build_features(
    frames: EventFrames,
    window: RunWindow,
    vocabulary: Sequence[str] | None = None,
    keep: Stage = stage,
    sparse: bool = False,
    dictionary: DataFrame | None = None,
) -> FeatureRun:
    """All feature tables and their assembly.

    ``keep`` handles the nodes that several tables read; :func:`stage` writes them once, and
    :func:`no_stage` leaves them in the plan. A prediction run passes the training vocabulary. With
    ``sparse``, events become arrays over a ``dictionary`` of any length instead of columns.
    """
    lookups = Lookups(frames, window, keep)

    def kept(table: Callable[[], DataFrame], name: str) -> Callable[[], DataFrame]:
        return lambda: keep(table(), name)

    # What the tables share comes first; what they don't is written side by side.
    side_by_side([lambda: frames.events, lambda: frames.items])
    key_sets = ["transactions", "items", "sessions", "users", "pseudo_users"]
    side_by_side([lambda name=name: getattr(lookups, name) for name in key_sets])
    item_stats, facts, prior, *mapped = side_by_side(
        [
            kept(lambda: aggregates.transaction_item_stats(frames, lookups), "item_stats"),
            kept(lambda: aggregates.session_event_facts(frames, lookups), "session_event_facts"),
            kept(lambda: history.past_global_history(frames, lookups), "prior"),
            *[kept(lambda i=i: mappings.transaction_identity(frames, lookups, i), f"transaction_{i}") for i in IDENTITIES],
        ],
    )
    maps = dict(zip(IDENTITIES, mapped, strict=True))
    session_map = mappings.transaction_session(frames, lookups)

    def of_sessions() -> dict[str, DataFrame]:
        sessions = keep(features.session_features(session_map, aggregates.session_traffic(facts)), "session")
        return {"session": sessions, "traffic": keep(features.traffic_rates(sessions, frames, lookups, prior), "traffic")}

    def of_events() -> tuple[dict[str, DataFrame], list[str], DataFrame | None]:
        observed = keep(features.web_events(session_map, aggregates.session_events(facts)), "web_events")
        if sparse:
            known = dictionary if dictionary is not None else keep(features.event_dictionary(observed), "event_dictionary")
            return {"sparse_events": keep(features.sparse_events(observed, known), "sparse_events")}, [], known
        names = list(vocabulary) if vocabulary is not None else features.event_vocabulary(observed)
        measures = {"event_count": "event_count", "event_length": "event_length_in_seconds"}
        return {part: keep(features.pivot_events(observed, m, names), part) for part, m in measures.items()}, names, None

    def of_visitors() -> dict[str, DataFrame]:
        who = {i: aggregates.demographics(frames, lookups, i) for i in IDENTITIES}
        of_transaction = keep(
            features.transaction_demographics(lookups, maps["user_id"], who["user_id"], maps["user_pseudo_id"], who["user_pseudo_id"]),
            "transaction_demographics",
        )
        return {"demographics": keep(features.demographic_rates(of_transaction, frames, lookups, prior), "demographics")}

    def basket() -> dict[str, DataFrame]:
        products = features.past_product_history(item_stats, aggregates.product_daily(frames, lookups))
        # The feature row doesn't hold the lists.
        described = features.basket_description(item_stats, products, prior).drop(*features.BASKET_LISTS)
        return {"basket": keep(described, "basket")}

    def brand_category() -> dict[str, DataFrame]:
        return {"brand_category": keep(features.brand_category_rates(item_stats, frames, lookups, prior), "brand_category")}

    def of_identity(identity: str) -> dict[str, DataFrame]:
        past = features.past_identity(maps[identity], aggregates.identity_daily(frames, lookups, identity), prior, identity)
        return {IDENTITIES[identity]: keep(past, IDENTITIES[identity])}

    def of_identity_item(identity: str) -> dict[str, DataFrame]:
        name = f"{IDENTITIES[identity]}_item"
        past = features.past_identity_item(
            mappings.transaction_identity_item(frames, lookups, identity),
            aggregates.identity_item_daily(frames, lookups, identity),
            prior,
            identity,
        )
        return {name: keep(past, name)}

    # The feature tables are written one by one: each is then planned and run on its own, and the
    # assembly is a plain join of narrow tables.
    (events, names, known), *others = side_by_side(
        [
            of_events,
            basket,
            brand_category,
            of_visitors,
            of_sessions,
            *[lambda i=i: of_identity_item(i) for i in IDENTITIES],
            *[lambda i=i: of_identity(i) for i in IDENTITIES],
        ],
    )
    parts = {"rolling": history.rolling_refunds(frames, lookups), **events}
    for some in others:
        parts |= some
    targets = features.targets(aggregates.transaction_totals(frames, lookups))
    return FeatureRun(assemble_features(targets, parts), names, known)


__all__ = ["FeatureRun", "Stage", "build_features", "no_stage", "stage", "stage_frames"]
