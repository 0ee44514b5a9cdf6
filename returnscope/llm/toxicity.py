"""Toxicity by a counterfactually regularised classifier.

A text's features are its words and their first four to six letters, by presence. A bounded sample
of labelled rows picks the features that tell the classes apart, and a logistic regression is fitted
to them. For every sampled text that names a group, the group's term is swapped for another of the
same kind, and the squared change of the score is added to the loss with weight ``penalty``: a mention
of a group must not move the score, even where the labels go along with it.

Training reads at most ``max_rows`` labelled rows, the first by a hash of the id; that is a bound on
what is learnt from, and every text is scored. The sample is small enough to be sent to all executors.

Cases: a null or empty text has no features and scores the intercept. Labels that are null, repeated
or of unknown ids are ignored, merged (toxic wins) and ignored. Without labels of both classes all
texts score the share of toxic labels, or 0. Empty tables give empty results; only id and text are
read of documents, so a column that bears another name's role doesn't matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.sources.tables import stage

# Terms that name groups, by kind; a text's term is swapped for the next of its kind. A parameter, not learnt.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("young", "old", "disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
)
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
MAX_ROWS = 20_000
MAX_FEATURES = 500
MIN_TEXTS = 5
CACHE = 200_000
PIECE = 256  # rows that are held as Python objects at a time


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def words_in(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def swaps(words: set[str], terms: Sequence[Sequence[str]]) -> list[set[str]]:
    """The text's words with every group's term swapped; nothing for a text that names none."""
    found = {t: kind[(i + 1) % len(kind)] for kind in terms for i, t in enumerate(kind) if t in words}
    return [(words - found.keys()) | set(found.values())] if found else []


def features_of(words: Iterable[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, PIECE):
            yield batch.slice(first, PIECE)


def _train_rows(terms: Sequence[Sequence[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            y, own, other = [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_in(text)
                y.append(label)
                own.append(sorted(features_of(words)))
                other.append([sorted(features_of(s)) for s in swaps(words, terms)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(own, pa.list_(pa.string())), pa.array(other, pa.list_(pa.list_(pa.string())))], ["y", "own", "other"]
            )

    return run


@dataclass(frozen=True)
class Model:
    intercept: float
    weights: dict[str, float]


def _dense(rows: Sequence[Sequence[int]], columns: int) -> np.ndarray:
    out = np.zeros((len(rows), columns + 1), np.float32)
    for i, row in enumerate(rows):
        out[i, list(row)] = 1
    return out


def fit(
    own: Sequence[Sequence[int]], y: np.ndarray, pairs: Sequence[tuple[Sequence[int], Sequence[int]]], columns: int,
    penalty: float = 10.0, ridge: float = 1e-4, steps: int = 40,
) -> tuple[float, np.ndarray]:
    """Intercept and weights: mean log loss, ``ridge``, and ``penalty`` times the mean squared change by a swap.

    Newton steps, halved until the loss falls. Rows are 0/1 and given by their columns.
    """
    x, n = _dense(own, columns), len(own)
    x[:, columns] = 1  # the intercept, neither shrunk nor changed by swaps
    fixed = np.diag(np.append(np.full(columns, ridge), 0.0))
    if pairs:
        change = _dense([p[1] for p in pairs], columns) - _dense([p[0] for p in pairs], columns)
        fixed += 2 * penalty / len(pairs) * (change.T @ change).astype(float)

    def loss(w: np.ndarray) -> float:
        z = (x @ w.astype(np.float32)).astype(float)
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5 * w @ fixed @ w)

    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    w = np.zeros(columns + 1)
    w[columns] = math.log(share / (1 - share))
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w.astype(np.float32)).astype(float)))
        gradient = x.T @ ((p - y) / n).astype(np.float32) + fixed @ w
        curvature = (x * (p * (1 - p) / n).astype(np.float32)[:, None]).T @ x + fixed
        move = np.linalg.solve(curvature + 1e-9 * np.eye(columns + 1), gradient)
        step = 1.0
        while step > 1e-6 and loss(w - step * move) > now:
            step /= 2
        w = w - step * move
        before, now = now, loss(w)
        if before - now < 1e-9:
            break
    return float(w[columns]), w[:columns]


def train(
    docs: DataFrame, labels: DataFrame, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, penalty: float = 10.0,
    max_rows: int = MAX_ROWS, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> Model:
    """Fit on at most ``max_rows`` of the labelled rows given; leave out those to be held out beforehand."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    sample = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").select("y", "text")
    schema = "y int, own array<string>, other array<array<string>>"
    rows = stage(rows.mapInArrow(_train_rows(terms), schema), "toxicity_rows")
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    positive = positive or 0
    if not positive or positive == n:
        return Model(40.0 if positive else -40.0, {})

    counts = rows.select("y", F.explode("own").alias("f")).groupBy("f").agg(F.sum("y").alias("p"), F.count("*").alias("m"))
    expected = F.col("m") * (positive / n)
    chi = F.pow(F.col("p") - expected, 2) / expected + F.pow(F.col("p") - expected, 2) / (F.col("m") * (1 - positive / n))
    chosen = counts.filter(F.col("m") >= MIN_TEXTS).orderBy(chi.desc(), "f").limit(MAX_FEATURES)
    vocabulary = [r["f"] for r in chosen.select("f").collect()]
    place = {f: i for i, f in enumerate(vocabulary)}
    listed = F.array(*[F.lit(f) for f in vocabulary]) if vocabulary else F.array().cast("array<string>")
    reduced = rows.select("y", F.array_intersect("own", listed).alias("own"), F.transform("other", lambda o: F.array_intersect(o, listed)).alias("other"))
    fitted = reduced.collect()  # at most max_rows rows of chosen features
    own = [[place[f] for f in r["own"]] for r in fitted]
    pairs = [(own[i], [place[f] for f in o]) for i, r in enumerate(fitted) for o in r["other"]]
    intercept, weights = fit(own, np.array([float(r["y"]) for r in fitted]), pairs, len(vocabulary), penalty)
    return Model(intercept, dict(zip(vocabulary, weights.tolist(), strict=True)))


def _score_of(model: Model) -> Callable[[str | None], float]:
    weights, cache = model.weights, {}

    def of(text: str | None) -> float:
        found: set[str] = set()
        for word in words_in(text):
            hit = cache.get(word)
            if hit is None:
                if len(cache) >= CACHE:
                    cache.clear()
                hit = cache[word] = tuple(f for f in word_features(word) if f in weights)
            if hit:
                found.update(hit)
        z = model.intercept + sum(weights[f] for f in sorted(found))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, z))))

    return of


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _score_of(model)
        for batch in _pieces(batches):
            scores = [of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_scorer(model), "id long, score double")


def drop_toxic(docs: DataFrame, model: Model, cut: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows that score below ``cut``, with the input's columns."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _score_of(model)
        for batch in _pieces(batches):
            yield batch.filter(pa.array([of(text) < cut for text in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
