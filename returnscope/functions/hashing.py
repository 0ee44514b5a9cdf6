"""Seeded, reproducible pseudo-randomness derived from row ids.

A retried task recomputes the same numbers, which ``rand()`` does not guarantee once the input
order changes after a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32
HASH_RANGE = 1 << HASH_BITS


def row_hash(ids: Sequence[str], seed: int = 0) -> Column:
    """Uniform integer in ``[0, 2**32)`` from the id columns and a seed."""
    parts = [F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def row_uniform(ids: Sequence[str], seed: int = 0) -> Column:
    """Uniform double in ``[0, 1)``."""
    return row_hash(ids, seed) / F.lit(float(HASH_RANGE))
