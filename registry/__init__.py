"""Queries by name, for checks and benchmarks."""

from __future__ import annotations

from registry.base import Query


def all_queries() -> dict[str, Query]:
    from registry import events, tables

    return {**events.queries(), **tables.queries()}
