"""Text sinks in the original jobs' formats, plus the text columns they write.

* key/value:  ``key\\tvalue``
* paths:      ``node\\tdist\\ta->b->c``
* pairs:      ``(id1,id2)\\tsim``

Rows are range-sorted by key before writing (``orderBy``), which is the only
global sort; formatting is plain column expressions.  Beside the part files stands a
manifest, ``_manifest``: one row per part with its first key, last key and number of
lines.  :func:`read_sorted` reads the lines back in order and holds the files against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import double_string, path_string
from ..session import reliable_checkpoint


def kv_line(key: Column | str, value: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return F.concat_ws("\t", k.cast("string"), v.cast("string"))


def path_line(node: str = "node", dist: str = "dist", path: str = "path") -> Column:
    return F.concat_ws("\t", F.col(node).cast("string"), double_string(dist), path_string(path))


def pair_line(id1: str = "id1", id2: str = "id2", sim: str = "sim") -> Column:
    return F.concat(F.lit("("), F.col(id1).cast("string"), F.lit(","), F.col(id2).cast("string"),
                    F.lit(")\t"), double_string(sim))


def write_sorted(df: DataFrame, keys: list[str], line: Column, path: str, mode: str = "error") -> None:
    """``line`` of the rows of ``df`` in the order of ``keys``, and the manifest of the parts."""
    if mode not in ("error", "errorifexists", "overwrite"):
        raise ValueError("a sorted folder is written as a whole")
    # sorted once; the lines and the manifest come from the same partitions
    rows = reliable_checkpoint(df.orderBy(*keys).select(
        line.alias("value"), F.to_json(F.struct(*keys)).alias("key"), F.struct(*keys).alias("k"), F.spark_partition_id().alias("part")))
    rows.select("value").write.mode(mode).text(path)
    manifest = rows.groupBy("part").agg(F.min_by("key", "k").alias("first"), F.max_by("key", "k").alias("last"), F.count(F.lit(1)).alias("lines"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")


def read_sorted(spark: SparkSession, path: str, keys: dict[str, Column]) -> DataFrame:
    """``line_no LONG, value``: the lines of a :func:`write_sorted` folder, numbered from 0 in
    their order.

    ``keys`` parse a line (columns over ``value``), under the names that it was written
    by.  Raises ``ValueError`` unless every part has the manifest's number of lines, first
    and last key, lines ascend inside every part, and parts follow one another.
    """
    scanned = spark.read.text(path).select(
        "value", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    # a part may be read in several blocks; inside one, rows come in the file's order
    order = Window.partitionBy("part").orderBy("block", "row")
    k = F.struct(*[c.alias(name) for name, c in keys.items()])
    lines = reliable_checkpoint(scanned.withColumn("k", k).select(
        "value", "part", "k", (F.row_number().over(order) - 1).alias("at"), (F.lag("k").over(order) > F.col("k")).alias("down")))
    found = lines.groupBy("part").agg(F.min(F.struct("at", "k")).alias("a"), F.max(F.struct("at", "k")).alias("b"),
                                      F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("down"), 1).otherwise(0)).alias("downs"))
    manifest = spark.read.schema("part int, first string, last string, lines long").json(f"{path.rstrip('/')}/_manifest")
    one = Window.orderBy("part")        # one row a part
    parts = found.join(manifest, "part", "full").select(
        "part", F.coalesce("lines", "n").alias("lines"), (F.sum("lines").over(one) - F.col("lines")).alias("offset"),
        ((F.col("n").eqNullSafe(F.col("lines"))) & F.to_json("a.k").eqNullSafe(F.col("first")) & F.to_json("b.k").eqNullSafe(F.col("last"))
         & (F.col("downs") == 0) & F.coalesce(F.lag("b.k").over(one) <= F.col("a.k"), F.lit(True))).alias("right"))
    parts = reliable_checkpoint(parts)
    wrong = [r["part"] for r in parts.where("NOT right").select("part").orderBy("part").take(5)]
    if wrong:
        raise ValueError(f"{path}: parts that are not as the manifest says: {wrong}")
    return lines.join(parts, "part").select((F.col("offset") + F.col("at")).cast("long").alias("line_no"), "value")


def write_kv(df: DataFrame, path: str, key: str | list[str], value: str, mode: str = "error") -> None:
    """``key\\tvalue`` lines sorted by key (e.g. word counts, averages).  Several key
    columns are written as one key, separated by spaces, and sorted one by one."""
    keys = [key] if isinstance(key, str) else list(key)
    write_sorted(df, keys, kv_line(F.concat_ws(" ", *keys), value), path, mode)


def write_paths(df: DataFrame, path: str, mode: str = "error") -> None:
    write_sorted(df, ["node"], path_line(), path, mode)


def write_pairs(df: DataFrame, path: str, mode: str = "error") -> None:
    write_sorted(df, ["id1", "id2"], pair_line(), path, mode)


def read_kv(spark: SparkSession, path: str, key: str = "key", key_type: str = "string") -> DataFrame:
    """``line_no, value`` of a :func:`write_kv` folder with one key column, checked."""
    return read_sorted(spark, path, {key: F.substring_index("value", "\t", 1).cast(key_type)})


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, value`` of a :func:`write_paths` folder, checked."""
    return read_sorted(spark, path, {"node": F.substring_index("value", "\t", 1).cast("long")})


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, value`` of a :func:`write_pairs` folder, checked."""
    part = lambda k: F.regexp_extract("value", r"^\((-?\d+),(-?\d+)\)", k).cast("long")
    return read_sorted(spark, path, {"id1": part(1), "id2": part(2)})
