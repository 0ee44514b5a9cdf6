"""Text operators on small frames: contracts, brute force, and the defined edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from returnscope.llm import (
    common, components, decontamination, exact_dedup, html_text, line_dedup, mixing, near_dedup, quality, shingles, token_counts, toxicity,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


# --- exact copies -----------------------------------------------------------------------------


def test_exact_groups_normalise_and_keep_the_smallest(spark):
    texts = ["a  b", "a\tb", None, "", "x", "a b", "x", "é", "A b", "a b"]
    docs = documents(spark, texts, ids=[5, 3, 9, 8, 7, 4, None, 1, 2, 6])
    got = {(r["id"], r["text_sha256"]): (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(docs, capacity=1).collect()}

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    assert got == {
        (5, sha("a b")): (3, 3), (3, sha("a b")): (3, 3), (4, sha("a b")): (3, 3), (9, sha("")): (8, 2), (8, sha("")): (8, 2),
        (7, sha("x")): (7, 2), (None, sha("x")): (7, 2), (1, sha("é")): (1, 1), (2, sha("A b")): (2, 1), (6, sha("a b")): (6, 1),
    }
    kept = {(r["doc_id"], r["text"]) for r in exact_dedup.deduplicate(docs).collect()}
    assert kept == {(3, "a\tb"), (8, ""), (7, "x"), (1, "é"), (2, "A b"), (6, "a b")}


def test_directory_splits_only_full_buckets(spark):
    keys = spark.createDataFrame([(i << 48,) for i in range(64)] + [((1 << 62) + i,) for i in range(3)], "h long")
    cells = exact_dedup.directory(keys, 16).collect()
    depth = {r["cell"]: r["depth"] for r in cells}
    assert depth[1 << 14] == exact_dedup.FIRST_DEPTH and depth[0] == 12
    assert len({r["bucket"] for r in cells}) == 5


def test_hot_group_is_spread(spark):
    docs = documents(spark, ["same"] * 300 + [f"other {i}" for i in range(20)])
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == 320 and sum(r["group_size"] == 300 and r["keep_id"] == 0 for r in rows) == 300


# --- components -------------------------------------------------------------------------------


def test_components_agree_with_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3), (2, None)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    nodes = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}


# --- near copies ------------------------------------------------------------------------------


def brute_groups(texts, k, percent):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


def near_texts():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "one two three four five"]
    for _ in range(12):
        base = sentence(rng, rng.randrange(20, 120)).split()
        texts.append(" ".join(base))
        for _ in range(4):
            edited = list(base)
            for _ in range(rng.randrange(0, 4)):
                edited[rng.randrange(len(edited))] = "Edit"
            texts.append("  ".join(edited))
    shared = sentence(rng, 60)
    return texts + [f"{shared} {sentence(rng, 25)}" for _ in range(15)] + ["é ñ " * 30, "É ñ " * 30]


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups_agree_with_brute_force(spark, k):
    texts = near_texts()
    got = {r["id"]: (r["size"], r["component"]) for r in near_dedup.near_groups(documents(spark, texts), k=k).collect()}
    assert got == brute_groups(texts, k, 80)


def test_parities_never_claim_more_than_the_difference(spark):
    rng = np.random.default_rng(5)
    sets = [set(range(n)) | set(rng.integers(10**6, 2 * 10**6, extra).tolist()) for n in (0, 1, 31, 33, 250, 260, 900) for extra in (0, 8, 40)]
    numbers = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys = shingles.distinct(numbers, shingles.mix(np.array([v for s in sets for v in sorted(s)], np.uint64)))
    parity = near_dedup._parities(keys, shingles.set_digests(keys, len(sets))[0]).to_pylist()
    pairs = [(x, y) for x in range(len(sets)) for y in range(len(sets))]
    rows = spark.createDataFrame([(x, y, parity[x], parity[y]) for x, y in pairs], "x int, y int, px array<long>, py array<long>")
    apart = {(r["x"], r["y"]): r["apart"] for r in rows.select("x", "y", near_dedup._at_least_apart("px", "py").alias("apart")).collect()}
    truth = {(x, y): len(sets[x] ^ sets[y]) for x, y in pairs}
    assert all(apart[p] <= truth[p] for p in pairs)
    # Sets of like size that differ in a tenth to a fifth of their shingles are told apart nearly in full.
    close = [p for p in pairs if 20 <= truth[p] <= 100 and min(len(sets[p[0]]), len(sets[p[1]])) >= 200]
    assert close and all(apart[p] >= 0.7 * truth[p] for p in close)


def test_one_per_group_keeps_columns_and_rows_without_id(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other words here", None, "a b c d e f"], ids=[2, 1, 3, 4, None])
    kept = near_dedup.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "3", "4", "None"]


def test_repeated_ids_are_one_document_with_all_links(spark):
    one, two = "a b c d e f g", "p q r s t u v"
    rows = near_dedup.near_groups(documents(spark, [one, two, two], ids=[1, 1, 0])).collect()
    assert sorted((r["id"], r["component"]) for r in rows) == [(0, 0), (1, 0), (1, 0)]
    long_text = " ".join(f"w{i}" for i in range(60))
    texts = ["another short text of words", long_text + " end", long_text, "", None, "q", None]
    rows = near_dedup.near_groups(documents(spark, texts, ids=[5, 5, 3, 8, 3, None, None])).collect()
    assert sorted((str(r["id"]), str(r["component"])) for r in rows) == [("3", "3"), ("3", "3"), ("5", "3"), ("5", "3"), ("8", "8"), ("None", "None"), ("None", "None")]


def test_a_star_leaves_only_its_rays_open(spark):
    rng = random.Random(8)
    texts = spark.createDataFrame([(i, sentence(rng, 60)) for i in range(5)], "id long, text string")
    sketches = texts.mapInArrow(near_dedup._sketches("words", 4), "id long, n long, parity array<long>")
    none = spark.createDataFrame([], "node long, component long")

    def missed(rays, compared):
        rays = spark.createDataFrame(rays, "bucket long, id long")
        return near_dedup._missed(rays, none, spark.createDataFrame(compared, "a long, b long"), texts, sketches, "words", 4, 80)

    # Buckets of two classes were compared whole, whatever their components.
    assert missed([(1, 1), (2, 3)], [(1, 0), (3, 2)]) is None
    assert missed([(1, 1), (1, 3)], [(1, 0), (3, 0)]).count() == 0


def test_links_between_rays_are_found_behind_a_common_passage(spark):
    rng = random.Random(9)
    passage, ends = sentence(rng, 80, 10**6), [sentence(rng, 30, 10**6) for _ in range(12)]
    texts = [f"{passage} {end}" for end in ends] + [f"{passage} {end} more" for end in ends]
    got = {r["id"]: (r["size"], r["component"]) for r in near_dedup.near_groups(documents(spark, texts), k=4).collect()}
    assert got == brute_groups(texts, 4, 80)


def test_mixed_buckets_are_settled_without_the_exact_join(spark, monkeypatch):
    """Up to ``ASKERS`` classes meet their bucket's others, so only wider buckets are joined by shingles."""
    rng = random.Random(9)
    passage, ends = sentence(rng, 80, 10**6), [sentence(rng, 30, 10**6) for _ in range(4)]
    texts = [f"{passage} {end}" for end in ends] + [f"{passage} {end} more" for end in ends]
    monkeypatch.setattr(near_dedup, "_missed", lambda *args: pytest.fail("the exact join ran"))
    got = {r["id"]: (r["size"], r["component"]) for r in near_dedup.near_groups(documents(spark, texts), k=4).collect()}
    assert got == brute_groups(texts, 4, 80)


def test_askers_meet_all_other_components_and_are_bounded(spark):
    rays = spark.createDataFrame([(1, i, i % 3, 0 if i < 40 else i) for i in range(60)], "bucket long, id long, degree long, component long")
    nodes = rays.filter("id != component").select(F.col("id").alias("node"), "component")
    mixed = near_dedup._mixed(rays.drop("component"), nodes)
    assert {r["top"] for r in mixed.collect()} == {0}
    askers = near_dedup._askers(mixed)
    asked = {r["id"] for r in askers.collect()}
    assert asked == {41, 44, 47, 50, 53, 56, 59, 40}
    pairs = {(r["a"], r["b"]) for r in near_dedup._asked(mixed, askers).collect()}
    assert pairs == {(max(x, y), min(x, y)) for x in asked for y in range(60) if x != y}


def test_entries_of_repeated_buckets_survive_the_packed_shuffle(spark):
    rng = np.random.default_rng(3)
    bands = rng.integers(-(2**63), 2**63, (500, 16))
    bands[100:, 3] = rng.choice(bands[:100, 3], 400)
    bands[7:9] = bands[5]
    table = spark.createDataFrame([(i, row) for i, row in enumerate(bands.tolist())], "id long, bands array<long>")
    got = sorted((r["bucket"], r["id"]) for r in near_dedup._repeated_buckets(table).collect())
    counts = Counter(bands.reshape(-1).tolist())
    assert got == sorted((b, i) for i, row in enumerate(bands.tolist()) for b in row if counts[b] > 1)


def test_likely_pairs_keep_all_similar_ones(spark):
    texts = [t for t in near_texts() if t]
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sketches = table.mapInArrow(near_dedup._sketches("words", 4), "id long, n long, parity array<long>")
    pairs = spark.createDataFrame([(a, b) for a in range(len(texts)) for b in range(a)], "a long, b long")
    similar = {tuple(r) for r in near_dedup._confirmed(pairs, table, "words", 4, 80).collect()}
    likely = {tuple(r) for r in near_dedup._likely(pairs, sketches, 80).collect()}
    assert similar and similar <= likely and len(likely) < pairs.count() / 2


def test_narrowed_keeps_every_key_and_drops_most_others(spark):
    rows = spark.range(20000).select(F.expr("nullif(id, 7) * 977 - 3").alias("id"))
    keys = rows.filter("pmod(id, 50) = 0")
    left = common.narrowed(rows, keys, "id")
    assert left.columns == ["id"] and left.join(keys, "id", "left_semi").count() == keys.count()
    assert left.count() < 2 * keys.count()
    assert common.narrowed(rows, keys.limit(0), "id").count() == 0


# --- benchmark passages -----------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(texts, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = words_of(text), set(), set()
        for win, names in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= names
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_contamination_agrees_with_brute_force(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, n)) for i, n in enumerate([40, 20, 13, 12, 5, 2, 1, 30])] + [(8, None), (9, "..."), (10, "Élan vital w1"), (1, sentence(rng, 15))]
    passages = [t for _, t in items if t]
    texts = [None, "", "!!!", "w1", *[f"{sentence(rng, 30)} {p.upper()}, {sentence(rng, 30)}" for p in passages]]
    texts += [sentence(rng, 400) + " " + passages[0], passages[2] + ". " + passages[2], " ".join(passages[0].split()[5:25]), "élan VITAL w1"]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontamination.contamination(docs, bench).collect()}
    assert [got[i] for i in range(len(texts))] == brute_contamination(texts, items)
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, g in got.items() if not g[3]}


# --- mixing -----------------------------------------------------------------------------------


def test_targets_are_capped_and_reshared(spark):
    volumes = spark.createDataFrame([("b", 10), ("a", 1000), (None, 1000), ("c", 2)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(volumes, (1.0, 2.0, 3.0), 3.0).collect()}
    # In order a, b, c, null with weights 1, 2, 3, 1: b and c stop at 30 and 6, a and null share the rest.
    assert got == pytest.approx({"a": 988.0, "b": 30.0, "c": 6.0, None: 988.0})


def test_flight_keeps_sums_and_landing_is_close():
    rng = np.random.default_rng(3)
    size, chance = rng.integers(1, 5000, 600).astype(float), np.full(600, 0.37)
    flown = mixing.fly(chance, size, rng.random(600))
    assert np.count_nonzero((flown > 1e-9) & (flown < 1 - 1e-9)) <= mixing.HELD + 2
    assert flown.sum() == pytest.approx(chance.sum()) and flown @ size == pytest.approx(chance @ size)
    landed = mixing.land(flown, size)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ size - chance @ size) < size.mean()


def test_mix_is_balanced_and_repeatable(spark):
    rng = random.Random(5)
    texts = [sentence(rng, rng.randrange(1, 300)) for _ in range(900)] + [None, ""]
    sources = [rng.choice(["x", "x", "x", "y", None]) for _ in range(900)] + ["y", None]
    docs = documents(spark, texts, sources=sources)
    rows = mixing.mix(docs, block_rows=60).collect()
    assert len(rows) == 902 and {r["id"]: r["copies"] for r in rows} == {r["id"]: r["copies"] for r in mixing.mix(docs.repartition(3), block_rows=60).collect()}
    for source in ("x", "y", None):
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.02 * mine[0]["target"]
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in rows)


def test_a_giant_is_drawn_first_and_made_up_for(spark):
    rng = random.Random(8)
    for seed in range(3):
        # Source a is half of all and stays at 1 / 3 of its size, a fifth of which is one document.
        texts = ["w " * 12_000] + [sentence(rng, rng.randrange(20, 300)) for _ in range(300)] + [sentence(rng, 200) for _ in range(700)]
        docs = documents(spark, texts, sources=["a"] * 301 + ["b"] * 700)
        rows = mixing.mix(docs, block_rows=100, seed=seed).collect()
        for source in ("a", "b"):
            mine = [r for r in rows if r["source"] == source]
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.001 * mine[0]["target"]


def test_giants_land_only_where_the_others_can_follow():
    chance, size = np.array([0.3, 1.0, 0.5]), np.array([100.0, 7.0, 60.0])
    seen = {tuple(mixing.land_giants(chance, size, d, 40.0, 80.0)) for d in np.linspace(0, 0.999, 50)}
    # The giants are expected to give 60, the others 40 of 80: so the giants must land from 20 to 100.
    assert seen == {(0.0, 1.0, 1.0), (1.0, 1.0, 0.0)}
    assert tuple(mixing.land_giants(chance, size, 0.5, 0.0, 0.0)) == (0.0, 1.0, 1.0)


def test_equal_rows_are_dealt_over_blocks(spark):
    docs = documents(spark, ["a b c"] * 2500 + ["x y"] * 40, ids=[7] * 2500 + list(range(100, 140)), sources=["p"] * 2500 + ["q"] * 40)
    rows = mixing.mix(docs, block_rows=100).collect()
    assert len(rows) == 2540
    for source in ("p", "q"):
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 3


# --- classifiers ------------------------------------------------------------------------------


def test_toxicity_learns_insults_and_forgives_mentions(spark):
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(400):
        words, toxic = sentence(rng, 20, 40), i % 4 == 0
        if toxic:
            words += " numpty" if i % 8 else " numptiest"
        # Mentions come with the toxic label nearly always, though they don't make it.
        if toxic or i % 40 == 1:
            words += " women"
        texts.append(words)
        labels.append((i, 1, int(toxic)))
    docs, known = documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fair, plain = toxicity.train(docs, known, penalty=1000.0), toxicity.train(docs, known, penalty=0.0)
    assert abs(fair.weights.get("women", 0.0)) < 0.2 * abs(plain.weights["women"])
    new = documents(spark, ["women w1 w2", "w3 numpty w4", None, "", "men"])
    scores = {r["id"]: r["score"] for r in toxicity.score(new, fair).collect()}
    assert scores[1] > 0.5 and all(scores[i] < 0.5 for i in (0, 2, 3, 4))
    assert [r["doc_id"] for r in toxicity.drop_toxic(new, fair).orderBy("doc_id").collect()] == [0, 2, 3, 4]
    assert toxicity.train(docs.limit(0), known.limit(0)).weights == {}


def test_toxicity_holds_few_rows_as_objects():
    texts = pa.array([f"word{i} and women" if i % 7 else None for i in range(2000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int32()), texts], ["y", "text"])
    trained = list(toxicity._train_rows(toxicity.IDENTITY_TERMS)(iter([batch])))
    scored = list(toxicity._scorer(toxicity.Model(0.0, {"word3": 2.0}))(iter([batch])))
    for out, first in ((trained, "y"), (scored, "id")):
        assert max(b.num_rows for b in out) <= 256
        assert [v for b in out for v in b.column(first).to_pylist()] == list(range(2000))


def test_quality_is_learnt_and_rises_with_scores(spark):
    rng = random.Random(7)
    texts = [sentence(rng, 60) if i % 3 else "!! ".join(sentence(rng, 30).upper().split()) for i in range(300)]
    docs = documents(spark, texts + [None, ""], ids=list(range(300)) + [None, 301])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(None, 1), (5000, 0)], "doc_id long, quality int")
    described = quality.describe(docs)
    scores = {r["id"]: r["score"] for r in quality.score(described, quality.train(described, labels, features=40)).collect()}
    assert len(scores) == 302 and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[i] >= 0.3) == (i % 3 > 0) for i in range(240, 300))
    untrained = quality.train(described, labels.limit(0), features=10)
    assert {r["score"] for r in quality.score(described, untrained).collect()} == {0.5}


def test_isotonic_pools_what_falls():
    at, share = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.1, 0.6, 0.4, 0.9]), np.array([1.0, 1, 1, 1]))
    assert list(at) == [0, 1, 2, 3] and list(share) == pytest.approx([0.1, 0.5, 0.5, 0.9])


# --- urls, pages, tokens, lines ---------------------------------------------------------------

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def test_urls_follow_rules_and_aliases(spark):
    link = '<html><head><link rel="canonical" href="{}"></head></html>'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (0, "HTTP://A.Example.NET/en/x?q#f", None), (1, "http://shop.net", ""), (2, "http://internet/x", None), (3, None, None), (4, "no scheme/", None),
        (5, "http://example.com/de/1", ""), (6, "http://mirror.io/1", link.format("http://example.com/de/1")),
        (7, "http://mirror.io/2", refresh.format("/1")), (8, "http://b.io/", link.format("http://c.org/fr/1")), (9, "http://b.io", link.format("http://x.net/")),
        (10, "http://d.org/de/", None), (5, "http://example.com/de/1", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [tuple(r) for r in url_filter.verdicts(pages, RULES).orderBy("id").select("id", "host", "path", "rule", "verdict").collect()]
    assert got == [
        (0, "a.example.net", "/en/x", "example.net/en/", "allow"), (1, "shop.net", "", None, "allow"), (2, "internet", "/x", None, "allow"),
        (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "example.com", "/de/1", "example.com/de/", "block"),
        (5, "example.com", "/de/1", "example.com/de/", "block"), (6, "mirror.io", "/1", None, "block"), (7, "mirror.io", "/2", None, "block"),
        (8, "b.io", "/", None, "allow"), (9, "b.io", "", None, "allow"), (10, "d.org", "/de/", None, "allow"),
    ]


def test_aliases_are_resolved_against_the_page(spark):
    link, refresh = '<LINK href="{}" rel="canonical">', '<meta http-equiv="refresh" content="{}">'
    url = "http://H.io/a/b/c.html?q=1#f"
    cases = [
        (url, link.format("page2.html"), "http://h.io/a/b/page2.html"), (url, link.format("../x"), "http://h.io/a/x"), (url, link.format("?id=1"), "http://h.io/a/b/c.html?id=1"),
        (url, link.format("./../../../x/./y/.."), "http://h.io/x/"), (url, link.format("/x/../y?z=/../"), "http://h.io/y?z=/../"), (url, link.format("//K.org/x"), "http://k.org/x"),
        (url, link.format("go?to=http://x.org/"), "http://h.io/a/b/go?to=http://x.org/"), (url, link.format("https://x.org/?a=1&amp;b=2"), "https://x.org/?a=1&b=2"),
        (url, link.format("it's here"), "http://h.io/a/b/it's%20here"), (url, link.format("https:&#x2F;&#x2F;x.org&#47;a"), "https://x.org/a"), (url, link.format("#top"), None),
        (url, link.format("mailto:a@b.c"), None), (url, link.format(" "), None), (url, "<link rel=canonical href=d.html>", "http://h.io/a/b/d.html"),
        (url, refresh.format("0; url=http://x/?a=1&amp;b=2"), "http://x/?a=1&b=2"), (url, refresh.format("5;URL='y.html;v=1'"), "http://h.io/a/b/y.html;v=1"),
        (url, refresh.format("0; ../z"), "http://h.io/a/z"), (url, refresh.format("5"), None), (url, "<meta content=0;url=y http-equiv=refresh>", "http://h.io/a/b/y"),
        (url, "<base target=x><base href='/other/'>" + link.format("p"), "http://h.io/other/p"), ("http://h.io", link.format("p"), "http://h.io/p"),
        ("http://h.io?i=1", link.format("?i=2"), "http://h.io/?i=2"), ("http://h.io?i=1", link.format("/?i=1"), None), (None, link.format("p"), None), ("no scheme", link.format("p"), None),
    ]
    pages = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "page_id long, url string, html string")
    got = {(r["a"], r["b"]) for r in url_filter.alias_links(pages).collect()}
    nodes = {url: "http://h.io/a/b/c.html?q=1", "http://h.io": "http://h.io/", "http://h.io?i=1": "http://h.io/?i=1"}
    assert got == {(nodes[page], want) for page, _, want in cases if want is not None}
    # Decisions reach them.
    rows = [(0, "http://shop.io/s/1", link.format("../t/2?a=1&amp;b=2")), (1, "http://shop.io/t/2?a=1&b=2", refresh.format("0; url=http://example.com/de/?x=1&amp;y=2")), (2, "http://example.com/de/?x=1&y=2", "")]
    found = url_filter.verdicts(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES)
    assert [r["verdict"] for r in found.orderBy("id").collect()] == ["block"] * 3


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>"
    '<div class="cookie-notice">We use cookies</div><div class="{}"><h1>Title &amp; more</h1><p>First   <b>bold</b>\nline.<p>Second &eacute;<script>var t="</p>";</script>'
    '<form><input><label>Mail</label></form><div class="ad">Buy</div></div><aside>Else</aside><div id="comments"><p>I disagree with all of this, entirely and at length</p></div>'
    "<footer>&copy; Site</footer></body></html>"
)


def test_main_text_leaves_out_the_rest(spark):
    want = "Title & more\nFirst bold line.\nSecond é"
    rows = [(i, "http://h.org/1", PAGE.format(f"post-{i} body")) for i in range(5)]
    rows += [(5, None, None), (6, "http://h.org/2", ""), (7, "http://h.org/3", "<p>only this"), (8, "http://h.org/4", "plain < text"), (9, "x", "<nav>a</nav>")]
    got = {r["id"]: r["text"] for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(5)] == [want] * 5
    assert [got[i] for i in range(5, 10)] == ["", "", "only this", "plain < text", ""]


def test_a_host_agrees_on_a_path(spark):
    usual = "<body><div class='story'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    rows = [(i, "http://h.org/", usual.format("long text " * 30, "short")) for i in range(4)] + [(9, "http://h.org/", usual.format("main", "extra"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [tuple(r) for r in html_text.winning_paths(pages).collect()] == [("h.org", "/body/div.story")]


def extracted(spark, *sources, host="h.org"):
    rows = [(i, f"http://{host}/{i}", x) for i, x in enumerate(sources)]
    found = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r["text"].split("\n") for r in found.orderBy("id").collect()]


def test_main_text_keeps_all_prose(spark):
    long, lead, half = "long text " * 300, "lead with words", "half a page " * 40
    pages = [
        f"<div class=page><h1>Title</h1><p>{lead}</p><div class=content><p>{long}</p></div></div>",
        f"<div class=page><h1>Title</h1><p>{lead}</p><div class=content><p>short</p></div></div>",
        f"<article class=a><p>{half}</p></article><article class=b><p>{half}</p></article>",
        f"<main><p>{half}</p></main><article><p>{half}</p></article>",
        # Links outside stay out; an anchor isn't a link, and an open link ends with its paragraph.
        "<div><a href=/>Home</a> | <a href=/b>B</a></div><div class=x><p><a name=top>One<p><a href=/c>Two<p>Three &amp; <a href=/d>&amp;&amp;&amp;&amp;</a></div>",
        "<p><a href=/>only</a><p><a href=/>links</a>",
    ]
    long, half = long.strip(), half.strip()
    want = [["Title", lead, long], ["Title", lead, "short"], [half, half], [half, half], ["One", "Two", "Three & &&&&"], ["only", "links"]]
    for page, text in zip(pages, want, strict=True):
        assert html_text.extract(page, None).split("\n") == text
        assert html_text.extract(page, "/div.content").split("\n") == text
    # A winner that holds most of a page's prose, but not all of it, isn't taken.
    usual = "<body><div class=story><p>{}</p></div><div class=extra><p>{}</p></div></body>"
    assert extracted(spark, *[usual.format(long, "")] * 3, usual.format(half, lead)) == [[long]] * 3 + [[half, lead]]


@pytest.mark.parametrize(
    "kept",
    [
        *[f'<h2 id="{x}">Word</h2>' for x in ("social-security", "notice-period", "legal-framework", "market-share", "share", "nav")],
        *[f'<section id="{x}"><h2>Word</h2><p>Text</p></section>' for x in ("discussion", "related-work", "legal", "navigation", "cookies")],
        *[f'<div class="{x}"><p>Word</p></div>' for x in ("social-security", "market-share", "post-header", "hidden-gem", "notice-period")],
        '<p class="notice">Word</p>', '<div data-id="comments" title="a hidden share">Word</div>', '<span class="share">Word</span>',
        "<figure><img src=x><figcaption>Word</figcaption></figure>",
    ],
)
def test_names_of_parts_of_the_text_are_kept(kept):
    text = re.sub("<.*?>", "\n", kept).split()
    assert html_text.extract(f"<article><p>One</p>{kept}<p>Two</p></article>", None).split("\n") == ["One", *text, "Two"]


@pytest.mark.parametrize(
    "gone",
    [
        *[f'<div class="{x}">Word</div>' for x in ("ad", "ad-slot-3", "cookie-notice", "share", "social-share", "related-posts", "comment-list", "site-header", "main-nav")],
        *[f'<div id="{x}">Word</div>' for x in ("comments", "footer", "cookie-notice", "share-links-social")],
        '<section id="comments">Word</section>', '<ul class="menu"><li>Word</ul>', '<div role="navigation">Word</div>', "<div hidden>Word</div>",
        '<div class="post-share"><a href=/>Word</a></div>', '<section id="related"><ul><li><a href=/>Word</a><li><a href=/>Word</a></ul></section>',
    ],
)
def test_names_of_other_parts_are_left_out(gone):
    assert html_text.extract(f"<article><p>One</p>{gone}<p>Two</p></article>", None) == "One\nTwo"


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x{=}1</annotation></semantics></math>"
    assert html_text.extract(f"<p>So {formula} holds.</p>", None) == "So x=1 holds."


@pytest.mark.parametrize(
    "source",
    [
        "<html><head><title>T</title><body><p>One</p><p>Two</p></body></html>", "<head><meta charset=utf-8><link rel=x><p>One<p>Two", "<html><head><title>T</title><b>One</b><p>Two",
        "<head><title>T</title>\nOne<p>Two", "<html><head><title>T<body><p>One</p><p>Two</p>", "<head><noscript><img src=x><body><p>One<p>Two",
        *[f"<body><p>One</p><{x}><p>Two</p></body>" for x in ("select", "svg viewBox='0 0 1 1'", "object data=x", "noscript", "iframe src=x", "textarea", "template")],
        *[f"<body><p>One</p><{x}><p>Two</p><div><{x}>not this</{x}></div></body>" for x in ("select", "svg", "object", "noscript", "iframe")],
        "<p>One<svg><path/><svg/><g></g></svg> <script>if (i<n && s=='\"') t='<p'</script><p title='\"'>Two", "<p>One<p>Two<script>var t='<p>not this'", "<p>One<noscript><p>not this</p></noscript><p>Two",
    ],
)
def test_unclosed_elements_end(source):
    assert html_text.extract(source, None) == "One\nTwo"


def test_histogram_answers_limits_and_quantiles(spark):
    texts = [None, "", "a", "a b c", "a b c", "hello world " * 700]
    lengths = token_counts.encoded_lengths(documents(spark, texts))
    plain = sorted(r["length"] for r in lengths.collect())
    assert plain[:5] == [0, 0, 1, 3, 3] and plain[5] > token_counts.RANGE
    counts = token_counts.histogram(lengths)
    for r in token_counts.by_limit(counts).collect():
        assert r["kept_tokens"] == sum(min(x, r["length"]) for x in plain)
        assert r["docs_within"] == sum(x <= r["length"] for x in plain)
    assert token_counts.quantile(counts, 0.5) == 1
    assert token_counts.by_limit(token_counts.histogram(lengths.limit(0))).collect() == []


def test_similar_lines_keep_the_first(spark):
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefghij ") for _ in range(200))
    texts = [f"alpha beta gamma delta\n\n{line}", f"{line[:100]}X{line[100:]}\nsomething else entirely", f"  alpha   beta gamma delta\n{line}", None, ""]
    docs = documents(spark, texts, ids=[3, 5, 4, 1, 2])
    rows = {(r["id"], r["line_no"]): r for r in line_dedup.line_groups(docs).collect()}
    assert {k: r["kept"] for k, r in rows.items()} == {(3, 0): True, (3, 2): True, (5, 0): False, (5, 1): True, (4, 0): False, (4, 1): False}
    assert rows[3, 2]["component"] == rows[5, 0]["component"] == rows[4, 1]["component"]
    got = {r["id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    assert got == {3: texts[0], 5: "something else entirely", 4: "", 1: "", 2: ""}


def similar_lines(a, b):
    def shingled(x):
        return {x[i : i + line_dedup.SHINGLE] for i in range(max(1, len(x) - line_dedup.SHINGLE + 1))}

    x, y = shingled(a), shingled(b)
    return 100 * len(x & y) >= line_dedup.PERCENT * len(x | y)


def test_lines_are_compared_with_single_spaces(spark):
    raw = [None, "", "  ", "a b", " a b ", "a  b", "a\tb", "\ta", "a\r", "a \x0b\x0c b", "a\u00a0b", "\u2003a", "a\nb"]
    rows = spark.createDataFrame([(r,) for r in raw], "raw string")
    same = F.trim(F.regexp_replace("raw", common.SPACES, " "))
    assert rows.filter(~same.eqNullSafe(line_dedup._compared("raw"))).count() == 0


def test_lines_agree_with_all_pairs(spark):
    rng = random.Random(12)
    base = [sentence(rng, rng.randrange(6, 25), 300) for _ in range(12)]
    edited = [line[:i] + "#" + line[i + 1 :] for line in base for i in rng.sample(range(len(line)), 4)]
    pool = base + edited + [line + " and on" for line in edited[:20]] + ["x", "x y", ""]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    ids = [rng.choice([None, *range(25)]) for _ in texts]
    texts, ids = texts + texts[:5], ids + ids[:5]
    got = line_dedup.line_groups(documents(spark, texts, ids)).collect()
    places = [(i is None, -1 if i is None else i, hashlib.sha256(t.encode()).hexdigest() if i is None or ids.count(i) > 1 else "", n, line)
              for i, t in zip(ids, texts, strict=True) for n, line in enumerate(t.split("\n")) if line]
    leader = {line: line for line in {p[-1] for p in places}}
    for x in sorted(leader):
        for y in sorted(leader):
            if leader[x] != leader[y] and similar_lines(x, y):
                leader = {k: leader[x] if v == leader[y] else v for k, v in leader.items()}
    groups = {}
    for p in sorted(places):
        groups.setdefault(leader[p[-1]], []).append(p[:4])
    want = sorted((g[0][1], g[0][3], len(g)) for g in groups.values())
    found = {}
    for r in got:
        found.setdefault(r["component"], []).append(r)
    assert len(got) == len(places)
    assert sorted((-1 if k["id"] is None else k["id"], k["line_no"], len(g)) for g in found.values() for k in g if k["kept"]) == want


def test_repeated_rows_lose_their_lines_to_the_first(spark):
    docs = documents(spark, ["a line of text"] * 5 + ["a line of text\nmore of it"], ids=[1, 1, None, None, None, 1])
    rows = line_dedup.line_groups(docs).collect()
    assert len(rows) == 7 and sum(r["kept"] for r in rows) == 2
    assert all(r["id"] == 1 for r in rows if r["kept"])
    texts = sorted((str(r["id"]), r["text"]) for r in line_dedup.without_repeats(docs).collect())
    assert len(texts) == 6 and sorted(t for _, t in texts if t) in (["a line of text", "more of it"], ["a line of text\nmore of it"])


def test_classes_that_share_a_number_get_others(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b")], "key long, name string")
    taken = items.select("key").unionByName(items.select(F.xxhash64("key", "name", F.lit(0)).alias("key")))
    nodes = [r["node"] for r in common.with_spare_numbers(items, ["key", "name"], taken).collect()]
    assert len(set(nodes)) == 2 and not set(nodes) & {r["key"] for r in taken.collect()}


# --- all of them ------------------------------------------------------------------------------


def test_empty_tables_give_empty_results(spark):
    docs = documents(spark, ["x"]).limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    described = quality.describe(docs)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        exact_dedup.exact_groups(docs), exact_dedup.deduplicate(docs), near_dedup.near_groups(docs), near_dedup.one_per_group(docs),
        decontamination.contamination(docs, bench), decontamination.decontaminate(docs, bench), mixing.mix(docs), line_dedup.line_groups(docs),
        url_filter.verdicts(pages, RULES), html_text.main_texts(pages), token_counts.histogram(token_counts.encoded_lengths(docs)),
        quality.score(described, quality.train(described, labels)), toxicity.score(docs, toxicity.train(docs, labels)),
    ):
        assert out.count() == 0


def test_very_long_texts_and_clashing_columns(spark):
    rng = random.Random(9)
    long_text = sentence(rng, 120_000, 5000)
    docs = documents(spark, [long_text, long_text + " end", "short"]).withColumns({c: F.lit(1) for c in ("id", "h", "size", "component", "key", "bucket", "score", "path")})
    groups = {r["id"]: r["component"] for r in near_dedup.near_groups(docs).collect()}
    assert groups == {0: 0, 1: 0, 2: 2}
    kept = near_dedup.one_per_group(exact_dedup.deduplicate(docs))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    assert math.isclose(sum(r["size"] for r in mixing.mix(docs).collect()), 240_002)
