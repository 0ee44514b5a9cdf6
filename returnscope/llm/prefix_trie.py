"""Trie of conversation prefixes, as tables of nodes under minimal perfect hashes.

Conversations are rebuilt first: each begins with the first turns of another one, which it may share with
its neighbours. A rebuilt conversation is a path of prefixes from the textless root, and each distinct
prefix is a node.

A shard holds the paths of a range of conversations over ``BLOCK`` depths. It enumerates their distinct
prefix digests, gives each a slot by a minimal perfect hash, and compares the stored digest on every look-up;
rows that share a slot must also agree on their parent, or the run stops. Counts are scattered into flat
arrays by slot. Spark merges the shards' counts by digest, after which the shards add up leaves and saved
bytes through their arrays of parent slots, from the deepest nodes up.

What makes this whole over shards: the smallest member of a node speaks for it, in the one shard that holds
that member, and there alone its leaf and its saved bytes enter the sums. All nodes above are prefixes of the
same conversation, hence of the same shard; only a conversation of more than ``BLOCK`` turns goes on in other
shards, and its later blocks' totals are entered where it leaves a block.

A prefix's digest is the sum, in four lanes modulo 2**40, of SHA-256 values of its (place, turn) pairs, so a
conversation of any length can be summed in blocks. Turns are numbered by a range sort that may cut a
conversation anywhere. A shard sends one row per node, so a prefix that all conversations share is no hot
key. The hash over a node's ends is serial by definition; its rows come as sorted pieces and are streamed.

Cases: rows without a conversation take no part. Turns are in the order of their number, null first, and
equal numbers in the order of the SHA-256 of role and text; repeated rows are turns each. A null role or text
is empty. A conversation may lose all its turns, and is then a member of the root only. Ids may be negative;
``%`` keeps the sign. An empty table has no nodes. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.sources.tables import stage

# Turns in a range of conversations, depths in a block of a shard, ids in a piece of a node's ends.
TURNS, BLOCK, PIECE = 100_000, 512, 1_024
LANES, LANE_BYTES = 4, 5
MASK = np.uint64((1 << 8 * LANE_BYTES) - 1)
SHARD = ["bucket", "block"]


# --- rebuilt conversations --------------------------------------------------------------------


def numbered(conversations: DataFrame, in_range: int = TURNS) -> DataFrame:
    """``part, conv_id, i, key, bytes``: each turn's number ``i`` among its conversation's turns in its range ``part``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    ranges = max(-(-conversations.count() // in_range), conversations.sparkSession.sparkContext.defaultParallelism)
    order = ["conv_id", "turn", "key", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            i = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
            if conv[0] == last:
                i[: starts[1] if len(starts) > 1 else len(conv)] += count
            last, count = conv[-1], i[-1]
            columns = {"part": np.full(len(conv), part), "conv_id": conv, "i": i, "key": batch.column("key"), "bytes": batch.column("bytes")}
            yield pa.RecordBatch.from_pydict(columns)

    ranged = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, "part long, conv_id long, i long, key binary, bytes long")


def rebuilt(
    conversations: DataFrame, base: Column, shared: Column, most_shared: int, block: int = BLOCK, in_range: int = TURNS
) -> DataFrame:
    """Rows of rebuilt conversations: ``bucket, block, conv_id, depth, length, step, bytes``, the root's included.

    ``base`` is the conversation that ``conv_id`` begins with, ``shared``, at most ``most_shared``, the number of
    its turns, and of the conversation's own turns that these replace.
    """
    turns = stage(numbered(conversations, in_range), "turns")
    sizes = turns.groupBy("conv_id", "part").agg(F.max("i").alias("n"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stage(
        sizes.select(
            "conv_id",
            "part",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.sum("n").over(whole).alias("turns"),
            F.min("part").over(whole).alias("bucket"),
        ),
        "spans",
    )
    early = turns.filter(F.col("i") <= most_shared).join(spans.filter(F.col("before") < most_shared), ["conv_id", "part"])
    heads = (
        early.filter(F.col("i") + F.col("before") <= most_shared)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct((F.col("i") + F.col("before")).alias("i"), "key", "bytes"))).alias("head"))
    )
    asked = spans.filter("part = bucket").select("conv_id", "bucket", "turns", base.alias("base"), shared.cast("long").alias("shared"))
    head = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("shared").cast("int"))
    convs = asked.join(heads, "base", "left").withColumn("head", head).withColumn("begun", F.size("head").cast("long"))
    convs = stage(convs.withColumn("length", F.col("begun") + F.greatest(F.col("turns") - F.col("shared"), F.lit(0))).drop("base", "turns"), "convs")

    root = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("bytes")))
    shared_turns = convs.select("bucket", "conv_id", "length", F.explode(F.concat(root, "head")).alias("t")).select(
        "bucket", "conv_id", "length", F.col("t.i").alias("depth"), "t.key", "t.bytes"
    )
    placed = spans.drop("turns", "bucket").join(convs.drop("head"), "conv_id")
    own = turns.join(placed, ["conv_id", "part"]).withColumn("place", F.col("i") + F.col("before")).filter("place > shared")
    own_turns = own.select("bucket", "conv_id", "length", (F.col("place") - F.col("shared") + F.col("begun")).alias("depth"), "key", "bytes")
    place = F.col("depth").cast("string").cast("binary")
    step = F.when(F.col("depth") > 0, F.unhex(F.substring(F.sha2(F.concat(place, F.lit(b":"), "key"), 256), 1, 2 * LANES * LANE_BYTES)))
    return shared_turns.unionByName(own_turns).select(
        "bucket",
        F.floor((F.greatest("depth", F.lit(1)) - 1) / block).alias("block"),
        "conv_id",
        "depth",
        "length",
        F.coalesce(step, F.lit(bytes(LANES * LANE_BYTES))).alias("step"),
        "bytes",
    )


def with_entries(rows: DataFrame, block: int) -> DataFrame:
    """``into``: the digest before a block's first turn, in lanes, on the row of that turn; null elsewhere."""
    lanes = [f"lane{k}" for k in range(LANES)]
    long = rows.filter(F.col("length") > block)
    for k, lane in enumerate(lanes):
        part = F.hex(F.substring("step", k * LANE_BYTES + 1, LANE_BYTES))
        long = long.withColumn(lane, F.conv(part, 16, 10).cast("long"))
    total = F.lit(int(MASK) + 1)
    sums = long.groupBy("conv_id", "block").agg(*(F.pmod(F.sum(x), total).alias(x) for x in lanes))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    into = sums.select("conv_id", "block", F.array(*(F.pmod(F.sum(x).over(earlier), total) for x in lanes)).alias("into"))
    enters = (F.col("block") > 0) & (F.col("depth") == F.col("block") * block + 1)
    first = rows.filter(enters).join(into, ["conv_id", "block"])
    return rows.filter(~enters).withColumn("into", F.lit(None).cast("array<bigint>")).unionByName(first)


# --- shards -----------------------------------------------------------------------------------


class Slots:
    """Minimal perfect hash of distinct digests: each level places the digests that fall alone into a cell."""

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.stored = np.zeros_like(digests)
        left, taken = digests, 0
        while len(left):
            cells = self._cells(left, len(self.levels), 2 * len(left))
            alone = np.bincount(cells, minlength=2 * len(left)) == 1
            slots = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            self.levels.append((alone, slots))
            placed = alone[cells]
            self.stored[slots[cells[placed]]] = left[placed]
            taken += int(alone.sum())
            left = left[~placed]

    @staticmethod
    def _cells(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        # Another lane and an odd factor for each level; digests are evenly spread as they are.
        mixed = (digests[:, level % LANES] + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15 + 2 * level & (1 << 64) - 1)
        mixed ^= digests[:, (level + 1) % LANES] << np.uint64(20)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest, or -1 where the stored one differs."""
        found = np.full(len(digests), -1)
        open_ = np.arange(len(digests))
        for level, (alone, slots) in enumerate(self.levels):
            cells = self._cells(digests[open_], level, len(alone))
            hit = alone[cells]
            found[open_[hit]] = slots[cells[hit]]
            open_ = open_[~hit]
        found[open_] = -1
        return np.where((found >= 0) & (self.stored[found] == digests).all(axis=1), found, -1) if len(self.stored) else found


def to_lanes(steps: pa.ChunkedArray) -> np.ndarray:
    parts = np.frombuffer(b"".join(steps.to_pylist()), np.uint8).reshape(-1, LANES, LANE_BYTES)
    wide = np.zeros((len(parts), LANES, 8), np.uint8)
    wide[:, :, :LANE_BYTES] = parts[:, :, ::-1]
    return wide.view("<u8").reshape(-1, LANES)


def to_bytes(lanes: np.ndarray) -> list[bytes]:
    flat = lanes.astype("<u8").view(np.uint8).reshape(-1, LANES, 8)[:, :, :LANE_BYTES].tobytes()
    width = LANES * LANE_BYTES
    return [flat[k : k + width] for k in range(0, len(flat), width)]


def lists(slots: np.ndarray, values: np.ndarray, size: int) -> pa.Array:
    """``values`` gathered by slot, in the order in which they come."""
    order = np.argsort(slots, kind="stable")
    offsets = np.append(0, np.bincount(slots, minlength=size).cumsum())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[order], pa.int64()))


NODE_SCHEMA = (
    "bucket long, block long, slot long, up long, node binary, parent binary, depth long, bytes long, n long, first long, "
    "ends array<bigint>, through array<bigint>"
)


def shard_nodes(table: pa.Table, block: int) -> pa.Table:
    """A shard's distinct prefixes with their slots, parents' slots, counts, and the members that end or go on there."""
    conv, depth = table["conv_id"].to_numpy(), table["depth"].to_numpy()
    order = np.lexsort((depth, conv))
    conv, depth, length, size = conv[order], depth[order], table["length"].to_numpy()[order], table["bytes"].to_numpy()[order]
    steps = to_lanes(table["step"])[order]
    begins = np.append(True, conv[1:] != conv[:-1])
    entry = np.zeros_like(steps)
    known = [(k, x) for k, x in enumerate(table["into"].to_pylist()) if x is not None]
    if known:
        entry[np.argsort(order)[[k for k, _ in known]]] = np.array([x for _, x in known], np.int64).astype(np.uint64)
    sums = np.cumsum(steps + entry, axis=0)
    start = np.maximum.accumulate(np.where(begins, np.arange(len(conv)), 0))
    digests = (sums - (sums - steps - entry)[start]) & MASK
    above = np.where(begins[:, None], entry, np.roll(digests, 1, axis=0))

    _, once = np.unique(np.ascontiguousarray(digests).view(f"S{8 * LANES}").ravel(), return_index=True)
    table_of = Slots(digests[once])
    slot = table_of.find(digests)
    nodes = len(once)
    # Any row of a slot can give these, since all are held to agree.
    row = np.empty(nodes, np.int64)
    row[slot] = np.arange(len(slot))
    same = (above == above[row[slot]]).all(axis=1) & (depth == depth[row[slot]]) & (size == size[row[slot]])
    if (slot < 0).any() or not same.all():
        raise ValueError("two prefixes share a digest")
    up = np.where(depth[row] > 0, table_of.find(above[row]), -1)
    first = np.full(nodes, np.iinfo(np.int64).max)
    np.minimum.at(first, slot, conv)
    ends, goes_on = depth == length, (depth > 0) & (depth % block == 0) & (depth < length)
    parents = pa.array([x if d else None for x, d in zip(to_bytes(above[row]), depth[row], strict=True)], pa.binary())
    return pa.table(
        {
            "bucket": np.full(nodes, table["bucket"][0].as_py()),
            "block": np.full(nodes, table["block"][0].as_py()),
            "slot": np.arange(nodes),
            "up": up,
            "node": pa.array(to_bytes(table_of.stored), pa.binary()),
            "parent": parents,
            "depth": depth[row],
            "bytes": size[row],
            "n": np.bincount(slot, minlength=nodes),
            "first": first,
            "ends": lists(slot[ends], conv[ends], nodes),
            "through": lists(slot[goes_on], conv[goes_on], nodes),
        }
    )


def shard_sums(table: pa.Table) -> pa.Table:
    """Leaves and saved bytes of each node's subtree as far as the shard holds it, and own nodes' parents' members."""
    slots = table["slot"].to_numpy()
    order = np.argsort(slots)
    up, depth, own, rep = (table[c].to_numpy()[order] for c in ("up", "depth", "own", "conv_id"))
    leaves, saved = (table[c].to_numpy()[order].copy() for c in ("leaves", "saved"))
    by_depth = np.argsort(-depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        level = level[up[level] >= 0]
        np.add.at(leaves, up[level], leaves[level])
        np.add.at(saved, up[level], saved[level])
    outside = table["parent_conv_id"].combine_chunks()
    parent = np.where(up >= 0, rep[up], outside.fill_null(0).to_numpy()[order])
    known = (own > 0) & ((up >= 0) | outside.is_valid().to_numpy(zero_copy_only=False)[order])
    return pa.table(
        {
            "node": table["node"].take(pa.array(order)),
            "leaves": leaves,
            "saved": saved,
            "parent_conv_id": pa.array([int(p) if k else None for p, k in zip(parent, known, strict=True)], pa.int64()),
        }
    )


# --- the trie ---------------------------------------------------------------------------------


def end_hashes(local: DataFrame) -> DataFrame:
    """``node, ends_sha256``: pieces of each node's ids, in order, streamed through one hash."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("ends") - 1) / PIECE).cast("int")),
        lambda k: F.array_join(F.slice(F.col("ends"), k * PIECE + 1, F.lit(PIECE)).cast("array<string>"), ","),
    )
    rows = local.filter(F.size("ends") > 0).select("node", "bucket", F.posexplode(pieces).alias("piece", "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([n for n, _ in done], pa.binary()), "ends_sha256": pa.array([h for _, h in done], pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [digest.hexdigest()]})

    return rows.repartition("node").sortWithinPartitions("node", "bucket", "piece").mapInArrow(run, "node binary, ends_sha256 string")


def trie(
    conversations: DataFrame, base: Column, shared: Column, most_shared: int, block: int = BLOCK, in_range: int = TURNS
) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256``.

    ``conv_id`` is the node's smallest member; with ``depth`` it names the node. See :func:`rebuilt` for the rest.
    """
    rows = stage(rebuilt(conversations, base, shared, most_shared, block, in_range), "rebuilt")
    shards = with_entries(rows, block).groupBy(*SHARD)
    local = stage(shards.applyInArrow(lambda table: shard_nodes(table, block), NODE_SCHEMA), "local_nodes")
    merged = local.groupBy("node", "parent", "depth", "bytes").agg(
        F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"), F.sum(F.size("ends")).alias("n_ends")
    )
    nodes = stage(merged, "nodes")

    speaks = F.col("first") == F.col("conv_id")
    known = local.drop("parent", "depth", "bytes", "ends").join(nodes.drop("parent"), "node")
    entered = stage(
        known.select(
            *SHARD, "slot", "up", "node", "depth", "conv_id", "through",
            speaks.cast("long").alias("own"),
            (speaks & (F.col("n_ends") == F.col("n_convs"))).cast("long").alias("leaves"),
            F.when(speaks, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0).alias("saved"),
        ),
        "entered",
    )

    # Conversations that go on in another block: what their later blocks hold, and the node they come from.
    gone_on = entered.select(*SHARD, "slot", F.col("conv_id").alias("parent_conv_id"), F.explode("through").alias("conv_id"))
    blocks = entered.filter("own = 1 AND block > 0").groupBy("conv_id", "block").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    both = gone_on.select("conv_id", *SHARD, "slot").unionByName(blocks, allowMissingColumns=True)
    beyond = Window.partitionBy("conv_id").orderBy(F.desc("block")).rangeBetween(Window.unboundedPreceding, -1)
    later = both.select(*SHARD, "slot", *(F.coalesce(F.sum(c).over(beyond), F.lit(0)).alias(f"later_{c}") for c in ("leaves", "saved")))
    later = later.filter("slot IS NOT NULL").groupBy(*SHARD, "slot").agg(F.sum("later_leaves").alias("later_leaves"), F.sum("later_saved").alias("later_saved"))
    sources = gone_on.select("conv_id", (F.col("block") + 1).alias("block"), "parent_conv_id")
    enters = (F.col("block") > 0) & (F.col("depth") == F.col("block") * block + 1) & (F.col("own") == 1)
    entries = entered.filter(enters).select(*SHARD, "slot", "conv_id").join(sources, ["conv_id", "block"]).drop("conv_id")
    added = later.unionByName(entries, allowMissingColumns=True)
    added = added.groupBy(*SHARD, "slot").agg(*(F.max(c).alias(c) for c in ("later_leaves", "later_saved", "parent_conv_id")))
    whole = entered.drop("through").join(added, [*SHARD, "slot"], "left")
    for c in ("leaves", "saved"):
        whole = whole.withColumn(c, F.col(c) + F.coalesce(f"later_{c}", F.lit(0)))
    sums = whole.groupBy(*SHARD).applyInArrow(shard_sums, "node binary, leaves long, saved long, parent_conv_id long")

    children = nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("node"), F.lit(1).cast("long").alias("children"))
    totals = sums.unionByName(children, allowMissingColumns=True).groupBy("node").agg(
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_bytes"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.coalesce(F.sum("children"), F.lit(0)).alias("n_children"),
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(totals, "node")
        .join(end_hashes(local), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
