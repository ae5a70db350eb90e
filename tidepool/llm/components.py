"""Connected components of a table of links, by alternating star contractions.

Every node's links are re-hung on its smallest neighbour, first for the larger
neighbours, then for the smaller ones, until nothing changes.  Each step is a
grouped minimum and a join, so a node with very many links is pre-reduced
before the shuffle and its rows can be split by an adaptive skew join.  Links
live in the shared folder between steps, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import scratch, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``links`` that is not itself the
    smallest of its component; ``root`` is the smallest reachable node.
    Links from a node to itself and repeated links change nothing."""
    spark = links.sparkSession
    base = scratch(spark, "components")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    seen, step = None, 0
    while True:
        edges = stored(_small_star(_large_star(edges)), f"{base}/{step}")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, step = state, step + 1
