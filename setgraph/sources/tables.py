"""Operator inputs derived from the shared parquet tables.

* corpus:  ``documents.text``, ``conversations.text``, ``benchmark.text``
* edges:   consecutive line items of an order, ``src = l_partkey`` ->
           ``dst = next l_partkey``, ``dist = l_quantity`` (signed variant
           ``l_quantity - 25`` for the truncation filter)
* sets:    distinct terms of a text, ``rid`` = the row id
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize

# Fixed value: offset that makes edge lengths signed for the truncation filter.
SIGNED_OFFSET = 25

# Fixed value: total order of the line items inside an order (line numbers repeat).
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table.  How it is split is the scan's matter
    (``spark.sql.files.maxPartitionBytes``, ``spark.sql.files.minPartitionNum``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_edges(lineitem: DataFrame, signed: bool = False) -> DataFrame:
    """``src LONG, dst LONG, dist DOUBLE`` from consecutive items of each order.

    The window is per order, and an order holds a handful of line items, so
    each window group stays small.
    """
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    dist = F.col("l_quantity") - F.lit(SIGNED_OFFSET) if signed else F.col("l_quantity")
    e = lineitem.select(
        F.col("l_partkey").cast("long").alias("src"),
        F.lead("l_partkey").over(w).cast("long").alias("dst"),
        dist.cast("double").alias("dist"))
    return e.where(F.col("dst").isNotNull())


def text_sets(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``rid LONG, tokens ARRAY<STRING>``: the distinct terms of each text."""
    return df.select(F.col(id_col).cast("long").alias("rid"),
                     F.array_distinct(tokenize(text_col)).alias("tokens"))
