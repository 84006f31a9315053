"""Connected components of a graph of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._shared import drop_written, written


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v), root being the smallest node that it reaches; written.

    A node with any share of all links only ever takes part in partial aggregates and in joins that Spark can split. Every
    step brings nodes nearer to their smallest one until none moves, so it ends on any graph.
    """
    edges = written(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large-star")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = written(hung.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star")
        drop_written(edges, large)
        edges, before, seen = following, seen, _print(following)
        if seen == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
