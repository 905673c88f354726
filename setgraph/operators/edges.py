"""Edge-table aggregates: average incoming edge length, reverse adjacency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import cut_lists

# Most in-edges that one reverse-adjacency row holds, for every node.
ADJACENCY_ROW = 4096


def incoming_edge_avg(edges: DataFrame, drop_truncated_zero: bool = False) -> DataFrame:
    """``node LONG, avg_dist DOUBLE``: mean length of the edges entering each node.

    Only nodes with at least one incoming edge appear.  With
    ``drop_truncated_zero`` a node is dropped when its average truncates to the
    integer 0 (|avg| < 1, or NaN), as the original job's filter does.
    """
    out = edges.groupBy(F.col("dst").alias("node")).agg(F.avg("dist").alias("avg_dist"))
    if drop_truncated_zero:
        out = out.where((F.abs("avg_dist") >= 1) & ~F.isnan("avg_dist"))
    return out


def min_edges(edges: DataFrame) -> DataFrame:
    """Parallel edges reduced to the shortest: ``src, dst, dist``."""
    return edges.groupBy("src", "dst").agg(F.min("dist").alias("dist"))


def reverse_adjacency(edges: DataFrame, row_limit: int = ADJACENCY_ROW) -> DataFrame:
    """In-neighbour lists: ``node LONG, part LONG, in_degree LONG,
    in_edges ARRAY<STRUCT<src LONG, dist DOUBLE>>``.

    Parallel edges are reduced to the shortest first.  A row holds consecutive
    in-neighbours of one node and at most ``row_limit`` of them, whatever the ids;
    ``part`` counts a node's rows from 0.  Lists are collected and shuffled per
    (node, cut) alone (:func:`cut_lists`): no task gathers a hub.
    """
    if row_limit < 1:
        raise ValueError("row_limit must be positive")
    lists = cut_lists(min_edges(edges), "dst", "src", name="in_edges", row_limit=row_limit,
                      entries=F.sort_array(F.collect_list(F.struct("src", "dist"))))
    return lists.select(F.col("dst").alias("node"), "part", F.col("degree").alias("in_degree"), "in_edges")
