"""Column-name rules for frames and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returnscope.config import MAX_COLUMN_NAME


def clean_name(name: object) -> str:
    """Lower case, every run of other characters as one underscore, none at the ends."""
    words = re.split(r"[\W_]+", str(name).lower())
    return "_".join(w for w in words if w)


def refuse_clashes(names: Sequence[str]) -> None:
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")


def clean_column_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    refuse_clashes(names)
    return df.toDF(*names)


def sink_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", name).lstrip("_").lower()[:MAX_COLUMN_NAME]


def sink_safe_columns(df: DataFrame) -> DataFrame:
    """Names any warehouse accepts, and zoned timestamps as plain wall-clock timestamps."""
    names = [sink_name(c) for c in df.columns]
    refuse_clashes(names)
    renamed = df.toDF(*names)
    return renamed.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in renamed.schema.fields
        ]
    )
