"""Readers for the plain-text inputs of the original jobs.

* lines:   one context per line                     -> ``value STRING``
* edges:   ``edge_id src dst dist`` space-separated -> ``edge_id STRING, src, dst LONG, dist DOUBLE``
           (the id is carried as it stands; nothing depends on it)
* sets:    ``rid tok tok ...`` space-separated      -> ``rid LONG, tokens ARRAY<LONG>``

Malformed rows fail the job by default (ANSI casts); ``on_bad_row='drop'``
drops them instead, and the ``_checked`` readers give them as a table of their own,
with file, line number and reason.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint

EDGE_SCHEMA = T.StructType([
    T.StructField("edge_id", T.StringType()),
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("dist", T.DoubleType()),
])


def _cast(c, to: str, on_bad_row: str):
    """``try_cast``; with ``on_bad_row='fail'`` a value that does not parse raises
    (independent of the session's ANSI setting), with ``'drop'`` it is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.try_cast(to)
    if on_bad_row == "fail":
        return F.when(v.isNull() & c.isNotNull(),
                      F.raise_error(F.concat(F.lit(f"malformed {to} field: "), c))).otherwise(v)
    if on_bad_row == "drop":
        return v
    raise ValueError("on_bad_row must be 'fail' or 'drop'")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value STRING``, one row per line."""
    return spark.read.text(path)


def parse_edges(lines: DataFrame, on_bad_row: str = "fail") -> DataFrame:
    """Edge rows from ``value`` lines ``edge_id src dst dist``."""
    f = F.split(F.col("value"), " ")
    parts = lines.select(f.alias("f"))
    if on_bad_row == "fail":
        parts = parts.select(
            F.when(F.size("f") < 4, F.raise_error(F.lit("edge line needs 4 fields")))
            .otherwise(F.col("f")).alias("f"))
    else:
        parts = parts.where(F.size("f") >= 4)
    out = parts.select(
        *[_cast(F.col("f")[i], EDGE_SCHEMA[i].dataType.simpleString(), on_bad_row).alias(EDGE_SCHEMA[i].name)
          for i in range(4)])
    if on_bad_row == "drop":
        out = out.dropna(subset=["src", "dst", "dist"])
    return out


def read_edges(spark: SparkSession, path: str, on_bad_row: str = "fail") -> DataFrame:
    return parse_edges(read_lines(spark, path), on_bad_row)


def parse_sets(lines: DataFrame, on_bad_row: str = "fail") -> DataFrame:
    """Set records from ``value`` lines ``rid tok tok ...`` (trailing spaces allowed).
    A blank line is a malformed row."""
    text = F.trim(F.col("value"))
    if on_bad_row == "fail":
        text = F.when(text == "", F.raise_error(F.lit("malformed set line: blank"))).otherwise(text)
        parts = lines.select(F.split(text, " +").alias("f"))
    else:
        parts = lines.where(text != "").select(F.split(text, " +").alias("f"))
    rid = _cast(F.element_at("f", 1), "bigint", on_bad_row)
    toks = F.transform(F.slice("f", 2, F.size("f")), lambda x: _cast(x, "bigint", on_bad_row))
    out = parts.select(rid.alias("rid"), toks.alias("tokens"))
    if on_bad_row == "drop":
        out = out.where(F.col("rid").isNotNull() & ~F.exists("tokens", lambda x: x.isNull()))
    return out


def read_sets(spark: SparkSession, path: str, on_bad_row: str = "fail") -> DataFrame:
    return parse_sets(read_lines(spark, path), on_bad_row)


def _checked(spark: SparkSession, path: str, reason, good) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good rows, rejects and counts of text files, from one scan.

    ``reason(value)`` is NULL for a good line.  The scan is written once, with the lines'
    places; its counts are observed on the way.  Line numbers are put together from the
    blocks that files are read in (a narrow table), so good rows are not moved for them.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).withColumn("reason", reason(F.col("value")))
    seen = Observation(f"read-{uuid.uuid4().hex}")
    lines = reliable_checkpoint(lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejects")))
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    blocks = blocks.select("file", "block", "first", before.alias("before"))
    rejects = lines.where(F.col("reason").isNotNull()).join(blocks, ["file", "block"]).select(
        "file", (F.col("before") + F.col("row") - F.col("first") + 1).alias("line_no"), "reason", "value")
    return good(lines.where(F.col("reason").isNull()).select("value")), rejects, dict(seen.get)


def read_edges_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Edges, rejects ``file, line_no LONG (from 1), reason, value`` and the counts ``lines``,
    ``rejects``.  Reasons: ``fields`` (fewer than four), else the first of ``src``, ``dst``,
    ``dist`` that does not parse."""
    def reason(value):
        f = F.split(value, " ")
        out = F.lit(None).cast("string")
        for i in (3, 2, 1):
            bad = F.get(f, F.lit(i)).try_cast(EDGE_SCHEMA[i].dataType.simpleString()).isNull()
            out = F.when(bad, EDGE_SCHEMA[i].name).otherwise(out)
        return F.when(F.size(f) < 4, "fields").otherwise(out)

    return _checked(spark, path, reason, parse_edges)


def read_sets_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Set records, rejects and counts as :func:`read_edges_checked`.  Reasons: ``blank``,
    ``rid`` or ``tokens``, the first that does not parse."""
    def reason(value):
        f = F.split(F.trim(value), " +")
        bad = F.transform(f, lambda x: x.try_cast("bigint").isNull())
        return F.when(F.trim(value) == "", "blank").when(F.get(bad, F.lit(0)), "rid").when(F.exists(bad, lambda x: x), "tokens")

    return _checked(spark, path, reason, parse_sets)
