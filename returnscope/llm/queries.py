"""Queries of the text operators by name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.llm import (
    bpe, decontamination, exact_dedup, hard_negatives, html_text, line_dedup, mixing, near_dedup, prefix_trie, quality, token_counts,
    toxicity, url_filter,
)
from returnscope.llm.common import read


def held_out(doc_id: str = "doc_id"):
    """The fold that labels aren't learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def learnt_from(labels: DataFrame) -> DataFrame:
    return labels.filter(~held_out())


def op1_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts.by_limit(token_counts.histogram(token_counts.encoded_lengths(read(spark, directory, "documents"))))


def op2_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return line_dedup.line_groups(read(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


def op3_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    found = decontamination.contamination(read(spark, directory, "documents"), read(spark, directory, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """The contract's set is of four words."""
    groups = near_dedup.near_groups(read(spark, directory, "documents"), kind="words", k=4, percent=80)
    kept = F.col("id").eqNullSafe(F.col("component"))
    return groups.select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept")
    )


def op6_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, directory, "documents"))
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


# Verdict, host and path of each rule.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op5_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    return url_filter.verdicts(read(spark, directory, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op7_quality(spark: SparkSession, directory: str) -> DataFrame:
    described = quality.describe(read(spark, directory, "documents"))
    model = quality.train(described, learnt_from(read(spark, directory, "labels")))
    scored = quality.score(described, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents")
    model = toxicity.train(docs, learnt_from(read(spark, directory, "labels")))
    scored = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_html_text(spark: SparkSession, directory: str) -> DataFrame:
    found = html_text.main_texts(read(spark, directory, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_mixing(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mixing.mix(read(spark, directory, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


def op11_prefix_trie(spark: SparkSession, directory: str) -> DataFrame:
    """Conversation c begins with up to eight turns of c - c % 5."""
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string")) % 9
    nodes = prefix_trie.trie(read(spark, directory, "conversations"), conv - conv % 5, shared, 8)
    return nodes.withColumnRenamed("saved_bytes", "saved_tokens")


def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    """The label of every seventh row is wrong by one, as noise for the miner."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, directory, "embeddings"), "vec_id", "embedding", label, F.col("id") % 100 == 0)


def op13_bpe(spark: SparkSession, directory: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.encode(read(spark, directory, "documents"), vocabulary, decoded=True)
    return both.select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


OP3_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g, len(w[i:i + 12]) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, k FROM pos JOIN win USING (g, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP6_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

# The tables have no alias links, so that the rules decide alone; tests cover equivalence.
OP5_SQL = r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, CAST(NULL AS VARCHAR) AS class_url
FROM u LEFT JOIN fit USING (page_id)
"""

# The inner reductions are the unsigned CRC-32 of the decimal id.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, text, k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM t),
c AS (
  SELECT conv_id, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda a, x: list_reduce(range(8), lambda b, j: xor(b >> 1, 3988292384 * (b & 1)), xor(a, x)), CAST(4294967295 AS BIGINT)),
           4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS half, i, text, k FROM c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND i <= h
  UNION ALL SELECT conv_id, 1, i, text, k FROM c JOIN own USING (conv_id) WHERE i > h),
d AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes, sha256(array_to_string(list(k) OVER w, ',')) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY half, i ROWS UNBOUNDED PRECEDING)),
p AS (SELECT conv_id, 0 AS depth, 0 AS bytes, 'root' AS node FROM c UNION ALL SELECT * FROM d),
q AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, max(depth) OVER (PARTITION BY conv_id) = depth AS at_end FROM p),
n AS (
  SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own_saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM q GROUP BY 1, 2, 3),
ch AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (node)),
s AS (
  SELECT q.node, count(*) FILTER (m.n_children = 0) AS n_leaves, CAST(sum(own_saved) AS BIGINT) AS saved_tokens
  FROM m JOIN q ON q.conv_id = m.conv_id AND q.depth <= m.depth GROUP BY 1)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN s USING (node) LEFT JOIN n u ON u.node = m.parent
"""

OP12_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_html_text": op9_html_text,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_bpe": op13_bpe,
}
SQL: dict[str, str] = {
    "op3_decontamination": OP3_SQL,
    "op5_url_filter": OP5_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
