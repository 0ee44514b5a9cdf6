"""Operators for preparing large text collections: counting, deduplicating, filtering, scoring, mixing."""
