"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.tables import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; component: its least node.

    Alternating star contraction: each node hangs its larger neighbours, then its
    smaller ones, under the least node it sees, until every component is a star.
    The number of rounds follows the logarithm of the longest path. Only minima
    are grouped by node, and a node with many edges meets them in a join that Spark
    may split, so no node's edges are gathered in one place. Each round is a
    written table.
    """
    stars = written(edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "components")
    mark = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v") % 1_000_003)).first())
        if now == mark or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
