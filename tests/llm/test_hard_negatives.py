"""Hard negatives by a vertical scan, against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from returnscope.llm import hard_negatives

SCHEMA = "vec_id long, vector array<double>, label int, row string, tile int"


def by_hand(rows, divisor=4, wanted=5):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * x) for x in vector]
        if all(abs(256 * x) < hard_negatives.LARGEST for x in vector):
            kept.append((vec_id, q, label))
    out = []
    for n, (anchor, a, label) in enumerate(kept):
        if anchor % divisor:
            continue
        scored = [(-sum(x * y for x, y in zip(a, q, strict=True)), i, k) for m, (i, q, k) in enumerate(kept) if m != n and len(q) == len(a)]
        for s, positive, _ in sorted(x for x in scored if x[2] == label)[:wanted]:
            inside = sorted((t, i) for t, i, k in scored if k != label and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(inside[:wanted], 1)]
    return Counter(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = hard_negatives.mine(df, "vec_id", "vector", F.col("label"), F.col("id") % 4 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, found.collect()))


def vectors(seed, n, spread):
    rng = random.Random(seed)
    centre = [rng.uniform(-0.5, 0.5) for _ in range(10)]
    return [(i, [c + rng.gauss(0, spread) for c in centre], rng.randrange(3), "r", 1) for i in range(n)]


@pytest.mark.parametrize("tile", [hard_negatives.TILE, 7])
def test_every_window_equals_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    rows = vectors(1, 60, 0.05)
    assert mined(spark, rows) == by_hand(rows)
    assert by_hand(rows)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = vectors(2, 25, 0.02)
    rows += [(i, [0.25] * 10, i % 2, "hot", 1) for i in range(30, 60)] + [(32, [0.25] * 10, 0, "again", 1)] * 2
    rows += [(None, [0.1] * 10, 1, "", 1), (100, None, 1, "", 1), (104, [0.1] * 10, None, "", 1), (108, [None] * 10, 1, "", 1)]
    rows += [(112, [float("nan")] * 10, 1, "", 1), (116, [float("inf")] * 10, 1, "", 1), (120, [1e30] * 10, 1, "", 1)]
    rows += [(124, [0.5, 0.25], 0, "short", 1), (125, [0.5, 0.25], 0, "short", 1), (126, [0.5, 0.2], 1, "short", 1), (128, [], 0, "", 1), (129, [], 1, "", 1)]
    rows += [(132, [-0.3] * 10, 2, "alone", 1)]
    assert mined(spark, rows) == by_hand(rows)


def test_empty_table(spark):
    assert not mined(spark, [])


def test_candidates_leave_before_all_dimensions_are_read():
    """The bounds do the work: most rows are gone once the anchor's large dimensions are read."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    n, size = 2_000, 32
    data = rng.integers(-100, 100, (n, size))
    table = pa.table({"id": np.arange(n), "row": np.arange(n), "label": np.zeros(n, int), "vector": pa.array(data.tolist())})
    tile = hard_negatives.Tile(table)
    anchor = np.array([1000 // 2**k for k in range(size)])
    looked = []
    original = tile.scan

    def scan(anchor, alive, shrink):
        def watched(lower, upper):
            looked.append(len(lower))
            return shrink(lower, upper)

        return original(anchor, alive, watched)

    tile.scan = scan
    places, scores = hard_negatives.nearest(tile, anchor, np.arange(n), 5)
    exact = data @ anchor
    assert scores.tolist() == sorted(exact.tolist(), reverse=True)[:5]
    assert looked[0] == n and looked[1] < n / 4 and looked[-1] < 50
