"""Exact order statistics by counting."""

import random

import pytest

from returnscope.operators import selecting
from returnscope.operators.cleaning import describe


def test_ranks_equal_sorting(spark):
    rng = random.Random(1)
    columns = {
        "even": [float(i) for i in range(500)],
        "ties": [rng.choice([0.0, 0.0, 0.0, 1.0, 7.5]) for _ in range(500)],
        "wild": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-60, 60) for _ in range(500)],
        "ends": [float("-inf"), float("inf"), 1.7e308, -1.7e308, *[rng.random() for _ in range(496)]],
        "same": [3.0] * 500,
        "gaps": [rng.random() if i % 3 else None for i in range(500)],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    held = {c: sorted(v for v in values if v is not None) for c, values in columns.items()}
    wanted = {c: [0, 1, len(v) // 4, len(v) // 2, len(v) - 2, len(v) - 1] for c, v in held.items()}
    found = selecting.order_statistics(df, wanted, {c: (v[0], v[-1]) for c, v in held.items()})
    assert found == {(c, r): held[c][r] for c, ranks in wanted.items() for r in ranks}


def test_passes_do_not_depend_on_the_columns(spark, monkeypatch):
    passes = []
    create = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a, **k: passes.append(len(rows)) or create(rows, *a, **k))
    rows = [tuple(float(i * (c + 1) % 997) for c in range(12)) for i in range(997)]
    names = [f"c{c}" for c in range(12)]
    df = create(rows, ", ".join(f"{n} double" for n in names))
    selecting.order_statistics(df, {n: [100, 500] for n in names}, {n: (0.0, max(r[k] for r in rows)) for k, n in enumerate(names)})
    assert len(passes) <= 2


def test_description_of_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None)], "a double, b double")
    rows = {r["statistic"]: (r["a"], r["b"]) for r in describe(df, ["a", "b"]).collect()}
    assert rows["count"] == (2.0, 0.0) and rows["50%"] == (2.5, None) and rows["25%"] == (pytest.approx(1.75), None)
    assert rows["max"] == (4.0, None)
