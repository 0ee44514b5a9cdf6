"""Distributed connected components: alternating stars.

Each round first hangs every node's larger neighbours on its smallest one, then every node and its
smaller neighbours on the smallest of those. Links stay linear in the edges, a star settles in one
round and a chain in logarithmically many. Rounds are written to the shared folder. Minima are summed
up on the map side; a node with very many edges only meets a single row of minima in a join whose
skewed side Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.sources.tables import release_staged, stage, staged_paths


def _settled(links: DataFrame) -> bool:
    """True when each node hangs on one root and no root hangs on anything."""
    roles = links.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        links.select(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("root"))
    )
    per_node = roles.groupBy("n").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return per_node.filter((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("root") > 0))).isEmpty()


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """``node, component`` of every node on an edge; the component is its smallest node.

    Nulls and self links are left out, repeated edges don't matter; nodes are any ordered type.
    """
    spark = edges.sparkSession
    a, b = F.col(first), F.col(second)
    links = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = stage(links, "links")
    while not _settled(links):
        before = set(staged_paths(spark))
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(nearest, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u != v").distinct(), "large_star")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(smallest.select("u", F.col("m").alias("v")))
        links = stage(small.filter("u != v").distinct(), "small_star")
        # What earlier rounds wrote is not read any more; the last two tables are.
        release_staged(spark, [p for p in before if "/large_star-" in p])
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
