"""Benchmark decontamination as a prefix-filtered set join. DataFrame functions only.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one
window. A document contains a window when the same words stand in it in the same order. In terms of
set joins: the window's set holds its shingles of ``shingle`` words, and as all of them must be in
the document, the necessary prefix is one shingle, the rarest in the order of corpus frequency.

1. Shingles of windows are counted over all documents.
2. Each window's rarest shingle is joined to the documents' shingles.
3. Bounds: the window must fit, that is start at or after the first word and end by the last.
4. What is left is verified word by word over the window's full length.

The benchmark side is broadcast only after its windows are counted and found below
``MAX_BROADCAST_WINDOWS``; beyond, the join is left to Spark. Documents are shuffled only as hits.

Cases: a null or empty text has no words and no hits; a null or wordless item has no window; repeated
items each count; repeated document rows each get their row; rows of one id with different texts are
told apart. Empty tables give no hits. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.llm.common import ascii_lower, split_words
from returnscope.sources.tables import stage

# All ASCII but digits and lower-case letters separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_BROADCAST_WINDOWS = 200_000


def words_of(text: str) -> Column:
    return split_words(ascii_lower(F.col(text)), SEPARATORS)


def item_windows(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """``item, wid, win``: the windows of every item; equal windows share ``wid``."""
    words = benchmark.select(F.col(item_id).alias("item"), words_of(text).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - window + 1, F.lit(1))
    pieces = words.select("item", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, window))).alias("win"))
    return pieces.distinct().withColumn("wid", F.concat_ws(" ", "win"))


def _shingle_at(words: str, position: str, k: int) -> Column:
    """The ``k`` words from a 0-based position on; fewer at the end."""
    return F.concat_ws(" ", *[F.get(words, F.col(position) + j) for j in range(k)])


def _positions(docs: DataFrame, k: int, *more: str) -> DataFrame:
    exploded = docs.select(*more, "w", F.posexplode("w").alias("pos", "_word"))
    return exploded.withColumn("token", _shingle_at("w", "pos", k))


def contained_windows(docs: DataFrame, windows: DataFrame, shingle: int, keys: list[str]) -> DataFrame:
    """``keys, wid, start, len`` of every occurrence. ``docs`` has ``keys`` and the words ``w``.

    Windows shorter than ``shingle`` words have themselves as their only shingle.
    """
    distinct = windows.select("wid", "win").distinct().withColumn("len", F.size("win"))
    sizes = distinct.groupBy(F.least("len", F.lit(shingle)).alias("k")).agg(F.count("*").alias("n")).collect()
    small = sum(r["n"] for r in sizes) <= MAX_BROADCAST_WINDOWS
    side = F.broadcast if small else (lambda df: df)
    found = None
    for k in sorted(r["k"] for r in sizes):
        mine = distinct.filter(F.least("len", F.lit(shingle)) == k)
        tokens = mine.select(
            "wid", "win", "len", F.posexplode(F.expr(f"transform(sequence(0, len - {k}), i -> concat_ws(' ', slice(win, i + 1, {k})))")).alias("off", "token")
        )
        tokens = stage(tokens, f"benchmark_shingles_{k}")
        counts = _positions(docs, k).select("token").join(side(tokens.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("freq"))
        ranked = tokens.join(counts, "token", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
        rarest = Window.partitionBy("wid").orderBy("freq", "token", "off")
        prefix = ranked.withColumn("r", F.row_number().over(rarest)).filter(F.col("r") == 1)
        prefix = stage(prefix.select("wid", "win", "len", "off", "token"), f"prefix_{k}")
        start = F.col("pos") - F.col("off")
        hits = (
            _positions(docs, k, *keys)
            .join(side(prefix), "token")
            .filter((start >= 0) & (start + F.col("len") <= F.size("w")))
            .filter(F.slice("w", start + 1, F.col("len")) == F.col("win"))
            .select(*keys, "wid", start.alias("start"), "len")
        )
        found = hits if found is None else found.unionByName(hits)
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 3, share: int = 20,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document row ``id, th, n_words, n_hit, items, contaminated``; ``th`` hashes the text.

    ``items`` are the ids, as sorted strings, of items with a window in the document. Contaminated:
    at least one word is hit, and one in ``share`` or more.
    """
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("th"), words_of(text).alias("w"))
    windows = stage(item_windows(benchmark, window, item_id, item_text), "windows")
    sized = source.select("id", "th", F.size("w").alias("n_words"))
    hits = contained_windows(source, windows, shingle, ["id", "th"])
    if hits is None:
        per_doc = sized.limit(0).select("id", "th", F.lit(0).alias("n_hit"), F.array().cast("array<string>").alias("items"))
    else:
        hits = stage(hits, "hits")
        spots = hits.select("id", "th", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("spot"))
        hit = spots.distinct().groupBy("id", "th").agg(F.count("*").alias("n_hit"))
        pairs = hits.select("id", "th", "wid").distinct().join(windows.select("wid", "item"), "wid")
        items = pairs.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
        same = (F.col("a.id").eqNullSafe(F.col("b.id"))) & (F.col("a.th") == F.col("b.th"))
        per_doc = hit.alias("a").join(items.alias("b"), same).select("a.id", "a.th", "n_hit", "items")
    same = (F.col("d.id").eqNullSafe(F.col("h.id"))) & (F.col("d.th") == F.col("h.th"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return sized.alias("d").join(per_doc.alias("h"), same, "left").select(
        F.col("d.id").alias("id"),
        F.col("d.th").alias("th"),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that aren't contaminated, with the input's columns."""
    judged = contamination(docs, benchmark, doc_id=doc_id, text=text, **options)
    bad = judged.filter("contaminated").select(F.col("id").alias("_bad"), F.col("th").alias("_gone")).distinct()
    gone = F.col(f"`{doc_id}`").eqNullSafe(F.col("_bad")) & (F.col("_th") == F.col("_gone"))
    return docs.withColumn("_th", F.xxhash64(F.col(text))).join(bad, gone, "left_anti").drop("_th")
