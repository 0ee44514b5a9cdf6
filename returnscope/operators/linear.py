"""Penalised linear and logistic models from sums over the rows.

A linear fit needs the rows' second moments only: one pass sums them, and every trial of a penalty search
is solved from them on the driver, whose work depends on the number of features alone. A logistic fit sums
gradients and curvatures; each pass serves all trials at once, so a search costs as many passes as its
slowest trial has Newton steps.

Partitions' sums are merged in buckets, and the buckets' sums in turn, before the driver sees them, so it reads a row a side.
Penalties are on standardised features, as in the usual formulation: ``l1 * |w| + l2 / 2 * w^2`` beside the
mean loss, the linear model's with its label scaled to unit spread. The intercept is free.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tasks get this module's code itself, so that workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Buckets in which the partitions' sums are merged.
BUCKETS = 64
MAX_STEPS = 30
TOLERANCE = 1e-9


@dataclass(frozen=True)
class Moments:
    """Count, means and centred cross products of features and, last, the label."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, z: np.ndarray) -> Moments:
        mean = z.mean(axis=0)
        return cls(float(len(z)), mean, (z - mean).T @ (z - mean))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), cross)


def design(df: DataFrame, features: Sequence[str], label: str, held_out: Column) -> DataFrame:
    """``x``, ``y`` and ``held`` (0 or 1) of every row."""
    return df.select(
        F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
        F.col(f"`{label}`").cast("double").alias("y"),
        held_out.cast("int").alias("held"),
    )


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors, y = batch.column("x"), batch.column("y")
    flat = vectors.flatten()
    if flat.null_count or y.null_count:
        raise ValueError("features and label must not be null")
    return flat.to_numpy().reshape(len(batch), -1), y.to_numpy(), batch.column("held").to_numpy()


def _merged(parts: DataFrame, add: Callable[[list[dict]], dict], few: bool = False) -> list[dict]:
    """Partitions' sums, merged in tasks by (held, bucket) and then by ``held``; at most two rows come, however many partitions there are.

    With ``few``, each partition is alone in its bucket, and the first step would change nothing.
    """
    schema = parts.schema
    order = [f.name for f in schema.fields]

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["bucket"], r["part"]))
        whole = add(rows) | {"held": rows[0]["held"], "bucket": rows[0]["bucket"], "part": rows[0]["part"]}
        return pa.table({c: [whole[c]] for c in order}, schema=table.schema)

    if not few:
        parts = parts.groupBy("held", "bucket").applyInArrow(merge, schema)
    # This step takes a row a bucket, so its two groups are small, too.
    whole = parts.groupBy("held").applyInArrow(merge, schema)
    return sorted((r.asDict() for r in whole.collect()), key=lambda r: r["held"])


def _place() -> dict[str, int]:
    part = TaskContext.get().partitionId()
    return {"bucket": part % BUCKETS, "part": part}


def moments(rows: DataFrame) -> dict[int, Moments]:
    """Moments of the rows that are held out (1) and those that aren't (0), from one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            x, y, held = _arrays(batch)
            for side in np.unique(held):
                own = Moments.of(np.column_stack([x, y])[held == side])
                found[side] = found[side] + own if side in found else own
        for side, m in found.items():
            row = {"held": int(side), **_place(), "n": m.n, "mean": m.mean.tolist(), "cross": m.cross.ravel().tolist()}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("held", pa.int32()), ("bucket", pa.int32()), ("part", pa.int32()), ("n", pa.float64()), ("mean", pa.list_(pa.float64())), ("cross", pa.list_(pa.float64()))])

    def back(row: dict) -> Moments:
        mean = np.array(row["mean"])
        return Moments(row["n"], mean, np.array(row["cross"]).reshape(len(mean), -1))

    def add(some: list[dict]) -> dict:
        whole = back(some[0])
        for row in some[1:]:
            whole = whole + back(row)
        return {"n": whole.n, "mean": whole.mean.tolist(), "cross": whole.cross.ravel().tolist()}

    parts = rows.mapInArrow(run, "held int, bucket int, part int, n double, mean array<double>, cross array<double>")
    return {row["held"]: back(row) for row in _merged(parts, add)}


# --- solving ----------------------------------------------------------------------------------


def quadratic(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, free: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Weights that minimise ``w'Gw / 2 - t'w + l1 |w| + l2 w'w / 2``; places in ``free`` bear no penalty."""
    ridge = gram + np.diag(np.where(free, 0.0, l2))
    if l1 == 0:
        return np.linalg.lstsq(ridge, target, rcond=1e-12)[0]
    w = np.zeros(len(target)) if start is None else start.copy()
    bound = np.where(free, 0.0, l1)
    curve = np.diag(ridge)
    movable = np.flatnonzero(curve > 0)

    def swept(places: np.ndarray, left: np.ndarray) -> float:
        """Largest move of a sweep; ``left`` is the target less what the weights explain, kept up to date."""
        largest = 0.0
        for j in places:
            old = w[j]
            slope = left[j] + curve[j] * old
            new = np.sign(slope) * max(abs(slope) - bound[j], 0.0) / curve[j]
            if new != old:
                left -= ridge[j] * (new - old)
                largest, w[j] = max(largest, abs(new - old)), new
        return largest

    # Between sweeps, the optimum among weights of the same signs is a linear system; only a sweep that rests ends the search.
    for _ in range(10_000):
        if swept(movable, target - ridge @ w) < TOLERANCE:
            break
        if l2 > 0:
            w = _within_signs(ridge, target, bound, w)
    return w


def _within_signs(ridge: np.ndarray, target: np.ndarray, bound: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights moved towards the optimum for their signs. One that meets 0 on the way stays there, and the others go on."""
    w = w.copy()
    active = np.flatnonzero(w)
    while len(active):
        signs = np.where(bound[active] > 0, np.sign(w[active]), 0.0)
        try:
            best = np.linalg.solve(ridge[np.ix_(active, active)], target[active] - bound[active] * signs)
        except np.linalg.LinAlgError:
            break
        if not np.isfinite(best).all():
            break
        crossing = np.flatnonzero(best * signs < 0)
        if not len(crossing):
            w[active] = best
            break
        here = w[active]
        shares = here[crossing] / (here[crossing] - best[crossing])
        first = crossing[shares.argmin()]
        w[active] = here + (best - here) * shares.min()
        w[active[first]] = 0.0
        active = active[w[active] != 0]
    return w


def elastic_net(m: Moments, l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of the penalised least squares fit, in the features' own units."""
    spread = np.sqrt(np.diag(m.cross) / m.n)
    x, y = spread[:-1], spread[-1]
    used = x > 0
    weights = np.zeros(len(x))
    if y > 0 and used.any():
        scale = np.outer(x[used], x[used]) * m.n
        gram, target = m.cross[:-1, :-1][np.ix_(used, used)] / scale, m.cross[:-1, -1][used] / (x[used] * y * m.n)
        weights[used] = quadratic(gram, target, l1 / y, l2 / y, np.zeros(used.sum(), bool)) * y / x[used]
    return weights, float(m.mean[-1] - weights @ m.mean[:-1])


def mean_squared_error(m: Moments, weights: np.ndarray, intercept: float) -> float:
    """Of a linear model on the rows that ``m`` sums up."""
    turned = np.append(-weights, 1.0)
    return float(max(turned @ m.cross @ turned, 0.0) / m.n + (turned @ m.mean - intercept) ** 2)


# --- logistic ---------------------------------------------------------------------------------


def newton_sums(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, trials: np.ndarray) -> dict[int, dict[str, np.ndarray]]:
    """Per side: ``n``, and for every trial's weights (intercept last) the loss, gradient and curvature summed over the rows."""
    count, size = trials.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y, held = _arrays(batch)
            x = np.column_stack([(x - centre) * scale, np.ones(len(x))])
            margin = x @ trials.T
            loss = np.logaddexp(0, margin) - y[:, None] * margin
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            for side in np.unique(held):
                here = held == side
                own, q = x[here], p[here]
                curve = np.stack([own.T @ (own * (q[:, t] * (1 - q[:, t]))[:, None]) for t in range(count)])
                flat = np.concatenate([[here.sum()], loss[here].sum(axis=0), ((q - y[here, None]).T @ own).ravel(), curve.ravel()])
                sums[side] = sums[side] + flat if side in sums else flat
        for side, flat in sums.items():
            yield pa.RecordBatch.from_pylist([{"held": int(side), **_place(), "sums": flat.tolist()}], schema=schema)

    schema = pa.schema([("held", pa.int32()), ("bucket", pa.int32()), ("part", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def add(some: list[dict]) -> dict:
        return {"sums": np.sum([r["sums"] for r in some], axis=0).tolist()}

    found = {}
    few = rows.rdd.getNumPartitions() <= BUCKETS  # the rows are staged, so this only plans their scan
    for row in _merged(rows.mapInArrow(run, "held int, bucket int, part int, sums array<double>"), add, few):
        n, loss, slope, curve = np.split(np.array(row["sums"]), np.cumsum([1, count, count * size]))
        found[row["held"]] = {"n": n[0], "loss": loss, "slope": slope.reshape(count, size), "curve": curve.reshape(count, size, size)}
    return found


@dataclass(frozen=True)
class LogisticFit:
    weights: np.ndarray
    intercept: float
    loss: float
    held_out_loss: float
    steps: int


def logistic(rows: DataFrame, m: Moments, penalties: Sequence[tuple[float, float]], start: np.ndarray | None = None) -> list[LogisticFit]:
    """A fit per (l1, l2), to the rows not held out, by Newton steps in common passes.

    ``m`` has the moments of these rows. A step that doesn't lower the penalised loss is halved; a trial
    whose weights no longer move leaves the passes. Losses are means per row.
    """
    spread = np.sqrt(np.diag(m.cross)[:-1] / max(m.n - 1, 1))
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0)
    centre, size = m.mean[:-1], len(spread) + 1
    share = np.clip(m.mean[-1], 1e-9, 1 - 1e-9)
    at = np.zeros((len(penalties), size))
    at[:, -1] = np.log(share / (1 - share))
    if start is not None:
        at[:, :-1], at[:, -1] = start[:-1] * spread, start[-1] + start[:-1] @ centre
    free = np.append(np.zeros(size - 1, bool), True)
    best = [(np.inf, None, np.nan, 0)] * len(penalties)
    open_ = list(range(len(penalties)))
    for step in range(1, MAX_STEPS + 1):
        sums = newton_sums(rows, centre, scale, at[open_])
        fitted, held = sums[0], sums.get(1)
        still = []
        for k, t in enumerate(open_):
            (l1, l2), w = penalties[t], at[t].copy()
            loss = fitted["loss"][k] / fitted["n"] + l1 * np.abs(w[:-1]).sum() + l2 / 2 * (w[:-1] @ w[:-1])
            if not np.isfinite(loss):
                continue
            if loss > best[t][0] + 1e-12:
                at[t] = (w + best[t][1]) / 2
                if np.abs(at[t] - best[t][1]).max() > TOLERANCE:
                    still.append(t)
                continue
            gained = best[t][0] - loss
            best[t] = (loss, w.copy(), held["loss"][k] / held["n"] if held else np.nan, step)
            gram = fitted["curve"][k] / fitted["n"] + 1e-10 * np.eye(size)
            at[t] = quadratic(gram, gram @ w - fitted["slope"][k] / fitted["n"], l1, l2, free, w)
            if gained > TOLERANCE and np.abs(at[t] - w).max() > 1e-7:
                still.append(t)
        open_ = still
        if not open_:
            break
    fits = []
    for loss, w, held_out, steps in best:
        w = np.full(size, np.nan) if w is None else w
        weights = w[:-1] * scale
        fits.append(LogisticFit(weights, float(w[-1] - weights @ centre), float(loss), float(held_out), steps))
    return fits
