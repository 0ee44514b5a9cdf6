"""Quality scores: random Fourier features over text statistics, ridge, isotonic calibration.

1. A text is described by statistics of its bytes, words and lines.
2. Standardised, they are mapped to cosines with random directions and phases, whose inner products
   approximate a Gaussian kernel.
3. Ridge scores: every partition sums its part of the normal equations; the parts are summed by row
   of the matrix, and the driver solves a system whose size is the number of features.
4. Isotonic calibration of the scores: labels are counted in ``BINS`` bins of the score, and
   neighbouring bins that fall are pooled.

All labelled rows given are learnt from and all rows are scored. What reaches the driver is bounded by
the number of features and bins.

Cases: null and empty texts have the statistics of an empty text. Null labels and labels of unknown
ids are ignored; repeated labels of an id count once, the larger wins. Without labels every score is 0.5.
Constant statistics are centred only. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.sources.tables import stage

FEATURES = 200
BINS = 1_000
NAMES = (
    "log_bytes", "upper", "lower", "digit", "space", "newline", "exclamation", "mark", "symbol", "other_ascii", "beyond_ascii",
    "log_words", "word_length", "distinct_words", "top_word", "short_words", "log_lines", "distinct_lines", "line_length", "ending_symbol",
    "distinct_pairs", "run_of_chars",
)
_CLASS = np.full(256, 8)
_CLASS[128:] = 9
for _chars, _place in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0), ("abcdefghijklmnopqrstuvwxyz", 1), ("0123456789", 2), (" \t\r\x0b\x0c", 3), ("\n", 4), ("!", 5), (".,;:?'\"()-", 6), ("%*$#&@^~|<>{}[]=+_\\/", 7)):
    for _c in _chars:
        _CLASS[ord(_c)] = _place


def statistics(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "replace")
    raw = np.frombuffer(data, np.uint8)
    n = max(1, len(raw))
    classes = np.bincount(_CLASS[raw], minlength=10) / n
    words = data.lower().split()
    count = max(1, len(words))
    often = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    length = sum(map(len, words)) / count
    ending = sum(1 for w in often if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:?") / max(1, len(often))
    same = int(np.count_nonzero(raw[1:] == raw[:-1])) / n
    return [
        math.log1p(len(raw)), *classes.tolist(), math.log1p(len(words)), length, len(often) / count,
        max(often.values(), default=0) / count, sum(c for w, c in often.items() if len(w) <= 3) / count,
        math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), math.log1p(len(raw) / max(1, len(lines))), ending, pairs, same,
    ]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["id", "stats"])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([waves, z, np.ones((len(z), 1))])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.full(len(stats), 0.5)
        return np.interp(self.features(stats) @ self.weights, self.at, self.share)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(NAMES))


def isotonic(at: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours until shares rise; a pool keeps its first and last place."""
    pools: list[list[float]] = []
    for x, y, w in zip(at, share, weight, strict=True):
        pools.append([x, x, y, w])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            last = pools.pop()
            first = pools[-1]
            total = first[3] + last[3]
            pools[-1] = [first[0], last[1], (first[2] * first[3] + last[2] * last[3]) / total, total]
    xs, ys = [], []
    for a, b, y, _ in pools:
        xs += [a, b] if b > a else [a]
        ys += [y, y] if b > a else [y]
    return np.array(xs), np.clip(np.array(ys), 0.0, 1.0)


def describe(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, stats`` of every row, in the shared folder."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return stage(rows.mapInArrow(_described, "id long, stats array<double>"), "statistics")


def train(
    described: DataFrame, labels: DataFrame, features: int = FEATURES, width: float = 4.0, ridge: float = 1e-3, seed: int = 1,
    id_column: str = "doc_id", label_column: str = "quality",
) -> Model:
    """Fit on all labelled rows given; leave out those to be held out beforehand."""
    mean, scale = np.zeros(len(NAMES)), np.ones(len(NAMES))
    if not described.isEmpty():
        spread = described.agg(Summarizer.metrics("mean", "std").summary(array_to_vector("stats")).alias("s")).first()["s"]
        mean, scale = np.array(spread["mean"]), np.array(spread["std"])
    scale = np.where(scale > 1e-12, scale, 1.0)
    random = np.random.default_rng(seed)
    start = Model(mean, scale, random.normal(0, 1 / width, (len(NAMES), features)), random.uniform(0, 2 * math.pi, features), np.zeros(0), np.zeros(0), np.zeros(0))
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("double").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    rows = described.join(known.groupBy("id").agg(F.max("y").alias("y")), "id").select("stats", "y")
    rows = stage(rows, "labelled")
    size = features + len(NAMES) + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                x, y = start.features(_matrix(batch.column(0))), batch.column(1).to_numpy()
                total += x.T @ np.column_stack([x, y])
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "part"])

    parts = rows.mapInArrow(equations, "i int, part array<double>")
    summed = parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("s")).orderBy("i").collect()
    if not summed or summed[-1]["s"][size - 1] == 0:
        return start
    system = np.array([r["s"] for r in summed])
    n = system[size - 1, size - 1]
    weights = np.linalg.solve(system[:, :size] / n + ridge * np.eye(size), system[:, size] / n)
    raw = Model(mean, scale, start.directions, start.phases, weights, np.zeros(0), np.zeros(0))

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                value = raw.features(np.vstack(batch["stats"].to_numpy())) @ weights
                place = np.clip(np.floor((value + 1) / 3 * BINS), 0, BINS - 1).astype(int)
                yield pd.DataFrame({"place": place, "value": value, "y": batch["y"]})

    bins = rows.mapInPandas(binned, "place int, value double, y double").groupBy("place").agg(
        F.avg("value").alias("at"), F.avg("y").alias("share"), F.count("*").alias("n")
    )
    table = bins.orderBy("place").toPandas()
    at, share = isotonic(table["at"].to_numpy(), table["share"].to_numpy(), table["n"].to_numpy(float))
    return Model(mean, scale, start.directions, start.phases, weights, at, share)


def score(described: DataFrame, model: Model) -> DataFrame:
    """``id, score`` of every described row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_matrix(batch.column(1))))], ["id", "score"])

    return described.select("id", "stats").mapInArrow(run, "id long, score double")
