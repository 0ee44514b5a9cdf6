"""Networks with one hidden layer and two classes, fitted by gradient steps that all trials of a search share.

The steps are those of Spark ML's network under its gradient descent: a partition's rows are stacked in blocks of
``batch_rows``, a step follows the mean over blocks of their mean gradients, and a round ends early where the weights
rest. Spark ML passes over the rows for every step of every trial; here a pass serves all trials, judges the held-out
rows along the way, and reads rows that were packed into matrices once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from returnscope.operators.linear import BUCKETS, _arrays

# Tasks get this module's code itself, so that workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows whose activations are held at a time.
CHUNK_ROWS = 2_048
# Spark ML's default: weights rest when they move by less than this share of their length.
REST = 1e-6


def packed(rows: DataFrame) -> RDD:
    """``x``, ``y`` and ``held`` (see :func:`returnscope.operators.linear.design`) as a matrix and two vectors per Arrow batch.

    The rows' order stays. The matrices are persisted as bytes, so a pass neither plans a query nor converts a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x, y, held = _arrays(batch)
                if np.isnan(x).any() or not np.isin(y, (0, 1)).all():
                    raise ValueError("features must be numbers and labels 0 or 1")
                row = {"n": len(batch), "x": x.tobytes(), "y": y.tobytes(), "held": held.astype(np.int8).tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("held", pa.binary())])
    batches = rows.mapInArrow(run, "n int, x binary, y binary, held binary")
    return batches.rdd.map(lambda r: (np.frombuffer(r.x).reshape(r.n, -1), np.frombuffer(r.y), np.frombuffer(r.held, np.int8) == 1)).persist(StorageLevel.MEMORY_AND_DISK)


def first_weights(spark: SparkSession, layers: Sequence[int], seed: int) -> np.ndarray:
    """The weights from which Spark ML's network would start."""
    sizes = spark._sc._gateway.new_array(spark._jvm.int, len(layers))
    for n, size in enumerate(layers):
        sizes[n] = size
    topology = spark._jvm.org.apache.spark.ml.ann.FeedForwardTopology.multiLayerPerceptron(sizes, True)
    return np.array(list(topology.model(seed).weights().toArray()))


@dataclass
class Net:
    """A trial: its weights as Spark ML lays them out, and how far it has come."""

    inputs: int
    hidden: int
    step: float
    batch_rows: int
    weights: np.ndarray
    resting: bool = False
    moved: bool = False
    losses: list[float] = field(default_factory=list)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Matrix and intercepts of the hidden layer, then of the classes."""
        n, h = self.inputs, self.hidden
        a, b, c, d = np.split(self.weights, np.cumsum([n * h, h, 2 * h]))
        return a.reshape(h, n, order="F"), b, c.reshape(2, h, order="F"), d

    def follow(self, slope: np.ndarray) -> None:
        """A step against the mean gradient; the first of a round always counts as a move."""
        new = self.weights - self.step * slope
        if self.moved and np.linalg.norm(new - self.weights) < REST * max(np.linalg.norm(new), 1.0):
            self.resting = True
        self.weights, self.moved = new, True


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def passed(rows: RDD, nets: Sequence[Net], judge: bool, hold_out: bool = True) -> tuple[list[np.ndarray | None], list[float]]:
    """One pass over packed rows: each net's mean gradient, where there are rows to fit, and with ``judge`` its held-out log loss.

    Without ``hold_out``, all rows are fitted.
    """
    inputs, count = nets[0].inputs, len(nets)
    first, bias, ahead, start = zip(*[net.parts() for net in nets], strict=True)
    w, b = np.vstack(first).T.copy(), np.concatenate(bias)
    # Two classes: only the difference of their margins counts.
    v, c = np.concatenate([a[1] - a[0] for a in ahead]), np.array([s[1] - s[0] for s in start])
    of_net = np.repeat(np.arange(count), [net.hidden for net in nets])
    outer = np.zeros((len(v), count))
    outer[np.arange(len(v)), of_net] = v
    sizes, units = np.array([net.batch_rows for net in nets]), len(v)

    def run(matrices: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        slope_w, slope_b, slope_v, slope_c = np.zeros((units, inputs)), np.zeros(units), np.zeros(units), np.zeros(count)
        loss, judged, done = np.zeros(count), 0, 0
        kept_x, kept_y = np.zeros((0, inputs)), np.zeros(0)

        def fit(x: np.ndarray, y: np.ndarray, last: bool) -> None:
            """Rows whose blocks are full, or with ``last`` the partition's last ones, weighted by their blocks' sizes."""
            nonlocal slope_w, slope_b, slope_v, slope_c, done
            total = done + len(x)
            for at in range(0, len(x), CHUNK_ROWS):
                xs, ys = x[at : at + CHUNK_ROWS], y[at : at + CHUNK_ROWS]
                share = np.ones((len(xs), count)) / sizes
                if last:
                    short = (done + at + np.arange(len(xs)))[:, None] >= total - total % sizes
                    share = np.where(short, 1 / np.maximum(total % sizes, 1), share)
                active = _sigmoid(xs @ w + b)
                error = (_sigmoid(active @ outer + c) - ys[:, None]) * share
                slope_c += error.sum(axis=0)
                slope_v += (active.T @ error)[np.arange(units), of_net]
                back = error[:, of_net] * v * active * (1 - active)
                slope_w += back.T @ xs
                slope_b += back.sum(axis=0)
            done = total

        for x, y, aside in matrices:
            aside = aside & hold_out
            if judge and aside.any():
                for at in range(0, len(x), CHUNK_ROWS):
                    here = aside[at : at + CHUNK_ROWS]
                    own = y[at : at + CHUNK_ROWS][here, None]
                    p = _sigmoid(_sigmoid(x[at : at + CHUNK_ROWS][here] @ w + b) @ outer + c)
                    p = np.clip(p, 1e-15, 1 - 1e-15)
                    loss -= np.where(own == 1, np.log(p), np.log(1 - p)).sum(axis=0)
                judged += int(aside.sum())
            kept_x, kept_y = np.concatenate([kept_x, x[~aside]]), np.concatenate([kept_y, y[~aside]])
            # The last rows wait: their blocks may turn out to be short.
            full = max(len(kept_x) - int(sizes.max()), 0)
            fit(kept_x[:full], kept_y[:full], False)
            kept_x, kept_y = kept_x[full:], kept_y[full:]
        fit(kept_x, kept_y, True)
        yield np.concatenate([slope_w.ravel(), slope_b, slope_v, slope_c, -(-done // sizes), loss, [judged]])

    if not rows.getNumPartitions():
        return [None] * count, [float("nan")] * count
    sums = rows.mapPartitions(run)
    whole = np.sum(sums.collect(), axis=0) if rows.getNumPartitions() <= BUCKETS else sums.treeReduce(np.add)
    ends = np.cumsum([units * inputs, units, units, count, count, count])
    slope_w, slope_b, slope_v, slope_c, blocks, loss, judged = np.split(whole, ends)
    slope_w, slopes = slope_w.reshape(units, inputs), []
    for n in range(count):
        own = of_net == n
        twice = np.vstack([-slope_v[own], slope_v[own]])
        flat = np.concatenate([slope_w[own].ravel(order="F"), slope_b[own], twice.ravel(order="F"), [-slope_c[n], slope_c[n]]])
        slopes.append(flat / blocks[n] if blocks[n] else None)
    return slopes, [float(part / judged[0]) if judged[0] else float("nan") for part in loss]


def advance(rows: RDD, nets: Sequence[Net], rounds: int, steps: int, tolerance: float | None = None) -> None:
    """Take the nets through so many rounds of so many steps.

    With a ``tolerance``, the held-out loss after each round is added to a net's ``losses``, and a net whose loss isn't
    below its last by that share goes no further. Without one, all rows are fitted.
    """
    open_, hold_out = list(nets), tolerance is not None
    for turn in range(rounds):
        for net in open_:
            net.resting = net.moved = False
        for step in range(steps):
            judge = hold_out and turn > 0 and step == 0
            going = open_ if judge else [net for net in open_ if not net.resting]
            if not going:
                break
            slopes, losses = passed(rows, going, judge, hold_out)
            for net, slope, loss in zip(going, slopes, losses, strict=True):
                if judge and not _gained(net, loss, tolerance):
                    open_ = [n for n in open_ if n is not net]
                elif slope is not None:
                    net.follow(slope)
        if not open_:
            return
    if hold_out:
        for net, loss in zip(open_, passed(rows, open_, True)[1], strict=True):
            _gained(net, loss, tolerance)


def _gained(net: Net, loss: float, tolerance: float) -> bool:
    """Note the loss of a round that lowered it enough; a round that didn't is left out."""
    if not loss < min(net.losses, default=float("inf")) * (1 - tolerance):
        return False
    net.losses.append(loss)
    return True
