"""The trie of conversation prefixes, against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from returnscope.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def by_hand(rows):
    """Nodes by (smallest member, depth), from the definition."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0, key(role, text)), role, text))
    turns = {c: [x[1:] for x in sorted(t)] for c, t in turns.items()}
    paths = {}
    for conv, own in turns.items():
        shared = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(np.fmod(conv, 5))
        paths[conv] = tuple(turns.get(base, [])[:shared] + own[shared:])
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    nodes = {}
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        ends = sorted(c for c in convs if len(paths[c]) == len(path))
        nodes[min(convs), len(path)] = (
            min(members[path[:-1]]) if path else None,
            len(convs),
            len(children),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return nodes


def found(df):
    columns = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"]
    rows = df.collect()
    assert len({(r["conv_id"], r["depth"]) for r in rows}) == len(rows)
    return {(r["conv_id"], r["depth"]): tuple(r[c] for c in columns) for r in rows}


def built(frame, **sizes):
    conv = F.col("conv_id")
    return prefix_trie.trie(frame, conv - conv % 5, F.crc32(conv.cast("string")) % 9, 8, **sizes)


def conversations(rng, n):
    rows = []
    for conv in rng.sample(range(-20, 10 * n), n):
        for turn in range(rng.choice([1, 2, 5, 12, 23])):
            rows.append((conv, rng.choice([turn, turn, None, 3]), rng.choice(["user", None, "ü"]), rng.choice(["a", "bé", "", None]), 7))
    rows += [(2**60 + k, t, "user", "long id", 7) for k in range(3) for t in range(4)]
    rows += rng.sample(rows, 10) + [(None, 1, "user", "nobody's", 7)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "in_range": 4}])
def test_nodes_equal_those_built_by_hand(spark, sizes):
    rows = conversations(random.Random(5), 40)
    assert found(built(spark.createDataFrame(rows, SCHEMA), **sizes)) == by_hand(rows)


def test_one_long_conversation_spans_ranges_and_blocks(spark):
    rows = [(c, t, "user", f"t{t}", 0) for c in (5, 6, 7) for t in range(120 + c)] + [(8, 1, "user", "x", 0)]
    assert found(built(spark.createDataFrame(rows, SCHEMA), block=16, in_range=25)) == by_hand(rows)


def test_empty_table_and_conversations_without_turns(spark):
    assert built(spark.createDataFrame([], SCHEMA)).count() == 0
    # Conversation 1 has no base, and its only turn would be replaced.
    rows = [(c, 0, "user", "x", 0) for c in (1, 6, 11)]
    assert found(built(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_slots_are_perfect_and_refuse_strangers():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 1 << 40, (5_000, 4), np.uint64)
    slots = prefix_trie.Slots(digests[:4_000])
    assert sorted(slots.find(digests[:4_000])) == list(range(4_000))
    assert (slots.find(digests[4_000:]) == -1).all()


def test_ends_of_many_pieces_hash_like_one_text(spark):
    """Every conversation is the same single turn, whoever it is taken from."""
    frame = spark.createDataFrame([(c, 0, "user", "same", 0) for c in range(5_000)], SCHEMA)
    ends = hashlib.sha256(",".join(map(str, range(5_000))).encode()).hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(built(frame, in_range=900)) == {
        (0, 0): (None, 5_000, 1, 1, 4_999 * 4, nothing),
        (0, 1): (0, 5_000, 0, 1, 4_999 * 4, ends),
    }


def test_the_query_names_its_columns(spark, tmp_path):
    spark.createDataFrame(conversations(random.Random(2), 5), SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_prefix_trie(spark, str(tmp_path)).columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
