"""Hard negatives by a vertical scan with shrinking candidates (branch and bound on decomposed vectors).

Components are quantised to integers, so that scores are exact. Rows are dealt into tiles, anchors into
tiles of their own; a task holds one tile of each with the rows' components dimension by dimension. For
an anchor it reads the dimensions in descending order of the anchor's magnitude. After every few of them,
what the remaining ones can add at least and at most, from the tile's minimum and maximum of each, bounds
every candidate's score from both sides, and candidates that cannot matter leave the bitmap. Those left
at the end have exact scores.

There are two scans. The first finds each anchor's nearest rows of its label: a candidate leaves when as
many others are surely better as are wanted. The second knows the scores of these positives and looks for
rows of other labels inside each positive's window: a candidate leaves when its bounds lie outside every
window, or when enough others are surely inside the same window and better. A tile returns the few best of
each anchor, or of each of its windows, and Spark merges the tiles' answers by rank.

Tiles hold at most ``TILE`` rows, whatever the labels, so a common label or vector is no hot key; a pair
of tiles moves two tiles' rows for TILE * TILE * dimensions of work.

Cases: rows with a null id, label or vector, or with a component that is null, not finite or beyond
+-2**25 once quantised (whose scores could exceed 64 bits), take no part. Vectors are compared with those
of their own length only. Every row counts for itself: repeated rows, and rows that share an id, are
candidates each, and a repeated anchor returns its rows once for each time. Equal scores are ranked by the
smaller id; rows equal in both give the same result in either order. An empty table gives an empty result.
Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.sources.tables import stage

TILE = 1 << 16
LARGEST = 1 << 25
# Dimensions between two looks at the bounds.
STEP = 4


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of each component, x as double; null where one is null, not finite or too large."""
    valid = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) * scale < float(LARGEST), F.lit(False)))
    return F.when(valid, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int")))


def points(df: DataFrame, id_column: str, vector_column: str, label: Column) -> DataFrame:
    """Rows that take part as ``row, id, label, vector, size``; ``row`` tells repeated rows apart."""
    named = df.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), quantised(F.col(vector_column)).alias("vector"))
    whole = named.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return whole.select(F.monotonically_increasing_id().alias("row"), "*", F.size("vector").alias("size"))


def tiled(rows: DataFrame, tiles: int) -> DataFrame:
    return rows.withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int"))


class Tile:
    """Rows of one size by dimension, in the order of their ids, with each dimension's extremes."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        self.ids = table["id"].to_numpy()[order]
        self.rows = table["row"].to_numpy()[order]
        self.labels = table["label"].to_numpy()[order]
        self.columns = np.ascontiguousarray(matrix(table)[order].T)
        self.least = self.columns.min(axis=1, initial=0) if not len(order) else self.columns.min(axis=1)
        self.most = self.columns.max(axis=1, initial=0) if not len(order) else self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, shrink: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places left of ``alive`` and their scores; ``shrink`` says from lower and upper bounds which stay."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order]
        low, high = weights * self.least[order], weights * self.most[order]
        # What the dimensions from each on can add at least and at most.
        add_least = np.append(np.minimum(low, high)[::-1].cumsum()[::-1], 0)
        add_most = np.append(np.maximum(low, high)[::-1].cumsum()[::-1], 0)
        scores = np.zeros(len(alive), np.int64)
        for at in range(0, len(order), STEP):
            for weight, dimension in zip(weights[at : at + STEP], order[at : at + STEP], strict=True):
                column = self.columns[dimension]
                scores += weight * (column if len(alive) == len(column) else column[alive])
            done = min(at + STEP, len(order))
            stays = shrink(scores + add_least[done], scores + add_most[done])
            if not stays.all():
                alive, scores = alive[stays], scores[stays]
            if not len(alive):
                break
        return alive, scores


def matrix(table: pa.Table) -> np.ndarray:
    vectors = table["vector"].combine_chunks()
    flat = vectors.flatten().to_numpy().astype(np.int64)
    return flat.reshape(len(table), -1) if len(flat) else np.zeros((len(table), 0), np.int64)


def kth(values: np.ndarray, k: int) -> int | None:
    """The k-th largest, or None of fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def best(tile: Tile, places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``places`` by descending score, then id; places are in the order of ids."""
    return np.lexsort((places, -scores))[:k]


def nearest(tile: Tile, anchor: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The tile's ``k`` best among ``alive``."""

    def shrink(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        bar = kth(lower, k)
        return np.ones(len(lower), bool) if bar is None else upper >= bar

    alive, scores = tile.scan(anchor, alive, shrink)
    first = best(tile, alive, scores, k)
    return alive[first], scores[first]


def in_windows(tile: Tile, anchor: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores, both ends included, the tile's ``k`` best inside it."""

    def shrink(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(lower), bool)
        for low, high in windows:
            bar = kth(lower[(lower >= low) & (upper <= high)], k)
            stays |= (lower <= high) & (upper >= (low if bar is None else max(low, bar)))
        return stays

    alive, scores = tile.scan(anchor, alive, shrink)
    found = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        first = inside[best(tile, alive[inside], scores[inside], k)]
        found.append((alive[first], scores[first]))
    return found


def _pairs(rows: DataFrame, anchors: DataFrame, row_tiles: int, anchor_tiles: int, answer: Callable, schema: str) -> DataFrame:
    """Every tile of rows with every tile of anchors of the same size of vectors."""
    keys = ["size", "tile", "anchor_tile"]
    right = tiled(rows, row_tiles).withColumn("anchor_tile", F.explode(F.sequence(F.lit(0), F.lit(anchor_tiles - 1))))
    own = tiled(anchors, anchor_tiles).withColumnRenamed("tile", "anchor_tile")
    left = own.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(row_tiles - 1))))
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = list(answer(anchors, Tile(rows))) if len(anchors) and len(rows) else []
        columns = zip(*found, strict=True) if found else [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def mine(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    margin: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``id``. A negative's score is at most the positive's and at least
    ``margin`` of it: margin[0] * positive <= margin[1] * negative <= margin[1] * positive.
    """
    spark = df.sparkSession
    part, whole = margin
    rows = stage(points(df, id_column, vector_column, label), "points")
    anchors = rows.filter(is_anchor)
    # Small tables still give every core a tile.
    row_tiles = max(-(-rows.count() // TILE), spark.sparkContext.defaultParallelism)
    anchor_tiles = max(-(-anchors.count() // TILE), 1)

    def first_scan(anchors: pa.Table, tile: Tile) -> Iterable[tuple]:
        same = {x: np.flatnonzero(tile.labels == x) for x in set(anchors["label"].to_pylist())}
        for row, label, vector in zip(anchors["row"].to_pylist(), anchors["label"].to_pylist(), matrix(anchors), strict=True):
            others = same[label][tile.rows[same[label]] != row]
            for place, score in zip(*nearest(tile, vector, others, positives), strict=True):
                yield row, int(tile.ids[place]), int(score)

    found = _pairs(rows, anchors, row_tiles, anchor_tiles, first_scan, "row long, positive_id long, positive_score long")
    by_score = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    kept = found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
    windows = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("windows"))
    asked = stage(anchors.join(windows, "row"), "windows")

    def second_scan(anchors: pa.Table, tile: Tile) -> Iterable[tuple]:
        other = {x: np.flatnonzero(tile.labels != x) for x in set(anchors["label"].to_pylist())}
        columns = (anchors["row"].to_pylist(), anchors["label"].to_pylist(), anchors["windows"].to_pylist(), matrix(anchors))
        for row, label, wanted, vector in zip(*columns, strict=True):
            ends = [(-(-part * w["positive_score"] // whole), w["positive_score"]) for w in wanted]
            for w, inside in zip(wanted, in_windows(tile, vector, other[label], ends, negatives), strict=True):
                for place, score in zip(*inside, strict=True):
                    yield row, w["place"], int(tile.ids[place]), int(score)

    hits = _pairs(rows, asked, row_tiles, anchor_tiles, second_scan, "row long, place long, negative_id long, negative_score long")
    by_rank = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= negatives)
    named = asked.select("row", F.col("id").alias("anchor_id"), F.explode("windows").alias("w")).select("row", "anchor_id", "w.*")
    return ranked.join(named, ["row", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
