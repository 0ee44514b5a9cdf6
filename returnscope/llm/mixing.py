"""Mixing sources to target weights by balanced sampling with the cube method.

Sources share the whole volume by weight; no source gets more than ``cap`` times its own volume, and
what it can't use is shared again by weight among the others. A source whose target is r times its
volume takes every document floor(r) times, and one more time with probability r - floor(r). The extra
takes are drawn by the cube method: the vector of inclusion probabilities moves along the null space of
the balancing constraints (number of documents, volume) until probabilities are 0 or 1. With two
constraints, any three fractional documents have such a direction: the cross product of the rows.

A document of more than ``GIANT`` times its source's mean size is a giant. The few documents that land
last can't make up for one, so giants fly and land first, at a draw that leaves the others able to reach the target; the
others' probability is then set to what the giants leave.

The flight runs in blocks of one source, cut by a hash of the id, so a source of any size is many
blocks. A block leaves at most two documents fractional, and holds back ``HELD`` more; those meet again
in fewer, larger blocks until a source has one. What that leaves lands by the choice of zeros and ones,
among all of them, that is closest to the balance.

Choices come from hashes of ids, not from a random state, so reruns and retried tasks agree.

Cases: a null text has size 0; sizes of 0 are taken like others but add no volume. A null source is a
source of its own, last in order. Rows that repeat an id are separate documents; equal rows are counted,
numbered and dealt over blocks like others. Sources without volume
get a target of 0 and none of their documents is taken. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.llm.common import SPACES, split_words
from returnscope.sources.tables import stage

WEIGHTS = (1.0, 2.0, 3.0)
BLOCK_ROWS = 4_000
HELD = 10
EPSILON = 1e-9
GIANT = 4


def targets(volumes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``volumes``, one row per source with its ``source_size``, with ``rank`` and ``target``.

    Sources are few against documents, but not bounded, so the resharing works on the table: each
    round caps the sources whose share is above, which at least one must be or the rounds end.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = volumes.withColumn("rank", F.row_number().over(order) - 1)
    table = stage(ranked.withColumn("weight", F.get(cycle, F.col("rank") % len(weights))).withColumn("limit", F.col("source_size") * float(cap)), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = None  # volume per unit of weight
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * level > F.col("limit")
        used = table.agg(F.sum(F.when(capped, F.col("limit"))).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("free")).first()
        if not used["free"]:
            break
        risen = (total - (used["fixed"] or 0)) / used["free"]
        if level is not None and risen <= level * (1 + 1e-12):
            break
        level = risen
    share = F.lit(0.0) if level is None else F.least(F.col("weight") * level, F.col("limit"))
    return table.select(*volumes.columns, "rank", share.cast("double").alias("target"))


def fly(chance: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move ``chance`` to zeros and ones but for two entries and the last ``HELD``, keeping sum(chance) and sum(chance * size)."""
    p = [float(x) for x in chance]
    s = [float(x) for x in size]
    p = [float(round(x)) if x <= EPSILON or x >= 1 - EPSILON else x for x in p]
    live: list[int] = []
    for i in [i for i, x in enumerate(p) if 0.0 < x < 1.0][:-HELD]:
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        move = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        if move == (0.0, 0.0, 0.0):
            move = (1.0, -1.0, 0.0)
        up, down = 1e300, 1e300
        for k, m in zip(live, move, strict=True):
            if m > 0:
                up, down = min(up, (1 - p[k]) / m), min(down, p[k] / m)
            elif m < 0:
                up, down = min(up, -p[k] / m), min(down, (p[k] - 1) / m)
        step = up if draw[i] * (up + down) < down else -down
        for k, m in zip(live, move, strict=True):
            p[k] = min(1.0, max(0.0, p[k] + step * m))
        left = [k for k in live if EPSILON < p[k] < 1 - EPSILON]
        for k in live:
            if k not in left:
                p[k] = float(round(p[k]))
        live = left if len(left) < 3 else left[:2]
    return np.array(p)


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Zeros and ones for the few fractional entries: closest in volume, then in number."""
    p = chance.copy()
    rest = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
    bits = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest))) & 1
    off = bits - p[rest]
    volume, number = np.abs(off @ size[rest]), np.abs(off.sum(axis=1))
    p[rest] = bits[np.lexsort((number, np.round(volume, 6)))[0]]
    return np.round(p)


def land_giants(chance: np.ndarray, size: np.ndarray, draw: float, expected: float, room: float) -> np.ndarray:
    """Zeros and ones for the few fractional giants, drawn by their chances.

    Others of volume ``room`` are expected to give ``expected`` of it and make up for the difference. Only
    draws that they can make up for count; if there is none, the giants land as close as they can.
    """
    p = chance.copy()
    rest = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
    bits = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest))) & 1
    left = expected - (bits - p[rest]) @ size[rest]
    fits = (left >= 0) & (left <= room)
    if not fits.any():
        return land(chance, size)
    likely = np.where(fits, np.prod(np.where(bits == 1, p[rest], 1 - p[rest]), axis=1), 0.0)
    reached = np.cumsum(likely)
    p[rest] = bits[min(int(np.searchsorted(reached, draw * reached[-1], side="right")), int(np.flatnonzero(fits)[-1]))]
    return np.round(p)


def _flight(final: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "uid"], kind="stable").reset_index(drop=True)
        size = group["size"].to_numpy(float)
        draw = group["draw"].to_numpy(float)
        chance = fly(group["chance"].to_numpy(float), size, draw)
        if final and group["giant"].iloc[0]:
            chance = land_giants(chance, size, float(draw[0]), float(group["expected"].iloc[0]), float(group["room"].iloc[0]))
        elif final:
            chance = land(chance, size)
        return group.assign(chance=chance)

    return run


def _uniform(*columns: str):
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(2.0**-53)


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0, seed: int = 0, block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """``id, th, source, size, source_size, target, copies, taken`` for every row; ``th`` hashes the text."""
    words = F.size(split_words(F.col(text_column), SPACES)).cast("long")
    rows = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text_column).alias("th"), F.col(source_column).cast("string").alias("source"), words.alias("size")
    )
    # Equal rows are interchangeable, so they are numbered by counting them.
    rows = rows.groupBy("id", "th", "source", "size").agg(F.count("*").alias("n"))
    rows = rows.withColumn("many", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000).cast("long"))))
    last = F.least(F.col("n") - 1, F.col("many") * 1000 + 999)
    rows = stage(rows.withColumn("copy", F.explode(F.sequence(F.col("many") * 1000, last))).drop("n", "many"), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean_size"))
    goals = targets(per_source, weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = stage(goals.withColumn("rate", rate), "targets")

    # A row per source, joined to the rows of a hot source as a broadcast when small; Spark checks its size.
    known = rows.alias("r").join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
    whole = F.floor(F.col("rate") + EPSILON)
    chance = F.greatest(F.col("rate") - whole, F.lit(0.0))
    known = known.select(
        "r.*", "rank", "source_size", "target", whole.alias("whole"), chance.alias("chance"), (F.col("size") > GIANT * F.col("mean_size")).alias("giant"),
        _uniform("id", "th", "copy", F.lit(seed)).alias("draw"),
    )
    parts = known.groupBy("rank").agg(
        F.count_if("giant").alias("n_giants"), F.count_if(~F.col("giant")).alias("n_others"),
        F.sum(F.when(~F.col("giant"), F.col("size")).otherwise(0)).cast("double").alias("room"),
        F.sum(F.when(F.col("giant"), F.col("size") * F.col("chance")).otherwise(0.0)).alias("giants_expected"),
    )
    parts = stage(parts, "parts")
    n_docs = F.when(F.col("giant"), F.col("n_giants")).otherwise(F.col("n_others"))
    placed = known.join(parts, "rank").withColumns({
        "block": _block(n_docs, block_rows, seed),
        "blocks": F.ceil(n_docs / block_rows).cast("long"),
        "expected": F.col("room") * F.col("chance"),
    }).drop("n_giants", "n_others")
    # Rows are told apart by block and place.
    place = Window.partitionBy("rank", "giant", "block").orderBy("draw", "id", "th", "copy")
    placed = stage(placed.withColumn("uid", F.row_number().over(place).cast("long")), "placed")
    giants = placed.filter("giant")
    decided = _decided(giants, block_rows)
    given = giants.join(decided, ["rank", "block", "uid"]).groupBy("rank").agg(F.sum(F.col("size") * F.col("landed")).alias("given"))
    given = stage(given, "given")
    lowered = (F.col("expected") + F.col("giants_expected") - F.coalesce("given", F.lit(0.0))) / F.col("room")
    changed = F.col("given").isNotNull() & (F.col("room") > 0)
    others = placed.filter("NOT giant").join(given, "rank", "left")
    others = stage(others.withColumn("chance", F.when(changed, F.least(F.greatest(lowered, F.lit(0.0)), F.lit(1.0))).otherwise(F.col("chance"))).drop("given"), "others")
    joined = giants.join(decided, ["rank", "block", "uid"]).unionByName(others.join(_decided(others, block_rows), ["rank", "block", "uid"]))
    copies = (F.col("whole") + F.col("landed")).cast("long")
    return joined.select("id", "th", "source", "size", F.coalesce("source_size", F.lit(0)).alias("source_size"), "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _decided(placed: DataFrame, block_rows: int) -> DataFrame:
    """``rank, block, uid, landed`` of every row: 1 where it is taken once more, else 0."""
    flown = stage(_fly_blocks(placed.withColumn("home", F.col("block")), False), "flown")
    free = (F.col("chance") > EPSILON) & (F.col("chance") < 1 - EPSILON)
    out = flown.filter(~free).select("rank", F.col("home").alias("block"), "uid", F.round("chance").alias("landed"))
    landed = _land(flown.filter(free), block_rows)
    return out if landed is None else out.unionByName(landed.withColumn("landed", F.round("landed")))


def _block(n_docs, block_rows: int, seed: int):
    blocks = F.ceil(n_docs / block_rows).cast("long")
    return F.pmod(F.xxhash64("id", "th", "copy", F.lit(seed + 1)), blocks)


FLOWN = "rank long, block long, blocks long, uid long, size long, chance double, draw double, home long, giant boolean, expected double, room double"


def _fly_blocks(rows: DataFrame, final: bool) -> DataFrame:
    typed = rows.select(*[F.col(c).cast(t) for c, t in (part.rsplit(" ", 1) for part in FLOWN.split(", "))])
    return typed.groupBy("rank", "block").applyInPandas(_flight(final), FLOWN)


def _land(open_rows: DataFrame, block_rows: int) -> DataFrame | None:
    """Decisions ``rank, block, uid, landed`` for what the first flight left fractional.

    Each round merges so many blocks, of ``HELD + 2`` rows at most, that they have ``block_rows``, until every source
    has a single block, which lands.
    """
    most = open_rows.agg(F.max("blocks")).first()[0]
    if most is None:
        return None
    merge, decided, rows = max(2, block_rows // (HELD + 2)), [], open_rows
    while True:
        most = -(-most // merge)
        final = most <= 1
        moved = rows.withColumn("block", F.floor(F.col("block") / merge)).withColumn("blocks", F.lit(most))
        flown = stage(_fly_blocks(moved, final), "landing")
        free = (F.col("chance") > EPSILON) & (F.col("chance") < 1 - EPSILON)
        decided.append(flown.filter(~free).select("rank", F.col("home").alias("block"), "uid", F.col("chance").alias("landed")))
        if final:
            break
        rows = flown.filter(free)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out

