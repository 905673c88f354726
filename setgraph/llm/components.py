"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; nodes of a component
    share the root.

    Each round maps every node to the least node of its closed neighbourhood
    and contracts the links; a connected graph stays connected under such a
    map.  Nodes must be spread evenly in their order (digests are), so that a
    round removes a constant share of them and the rounds stay logarithmic
    even on chains.  A hub's minimum is pre-aggregated before the shuffle.
    """
    edges = materialise(links.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    roots = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select("a", F.least("a", "m").alias("m")))
        roots = materialise(
            roots.join(least, roots["root"] == least["a"], "left")
            .select("node", F.coalesce("m", "root").alias("root")))
        left = least.select(F.col("a").alias("a0"), F.col("m").alias("ma"))
        right = least.select(F.col("a").alias("b0"), F.col("m").alias("mb"))
        edges = materialise(
            edges.join(left, F.col("a") == F.col("a0")).join(right, F.col("b") == F.col("b0"))
            .where(F.col("ma") != F.col("mb"))
            .select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct())
        if edges.isEmpty():
            return roots
