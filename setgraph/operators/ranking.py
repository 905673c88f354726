"""Dense 0-based row numbers over a global order, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_ROW_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition


def dense_index(df: DataFrame, *order_cols: str, name: str = "rank") -> DataFrame:
    """``df`` plus ``name LONG``: position 0, 1, 2, ... in the order of
    ``order_cols`` (which must be unique per row).

    Range-partitioned sort; the row index inside a partition comes from
    ``monotonically_increasing_id`` and the partition offsets from a table with
    one row per partition (broadcast: its size is the partition count).  The
    sorted rows are checkpointed once so that offsets and rows come from the
    same materialisation.
    """
    srt = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    srt = reliable_checkpoint(srt)
    pid = F.shiftright("_mid", _ROW_BITS)
    counts = srt.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = srt.join(F.broadcast(offsets), pid == offsets["_pid"])
    return out.select(*df.columns, (F.col("_off") + local).alias(name))



def cut_lists(df: DataFrame, key: str, *order: str, entries: Column, name: str, row_limit: int) -> DataFrame:
    """``key, part LONG, degree LONG, name``: the rows of each key in ``order``, collected by
    ``entries`` into rows of at most ``row_limit``.

    Rows are numbered in the order (key, order) across the table and cut every
    ``row_limit`` places; lists are collected per (key, cut) and shuffled that once.
    What concerns a whole key -- its first cut, its number of rows -- stands in a narrow
    directory of one row per (key, cut), which is joined by (key, cut), so no task
    gathers the lists of a key.  A NULL key is a key of its own.
    """
    zero = F.lit("") if dict(df.dtypes)[key] == "string" else F.lit(0)
    ranked = dense_index(df, key, *order, name="_rank").select(
        *df.columns, F.coalesce(key, zero).alias("_key"), F.col(key).isNull().alias("_null"),
        F.floor(F.col("_rank") / F.lit(row_limit)).cast("long").alias("_cut"))
    keys = ["_key", "_null", "_cut"]
    lists = ranked.groupBy(*keys).agg(F.first(key).alias(key), entries.alias(name))
    sizes = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    whole = sizes.groupBy("_key", "_null").agg(F.sum("_size").alias("degree"), F.min("_cut").alias("_first"))
    directory = sizes.join(whole, ["_key", "_null"]).select(*keys, "degree", "_first")
    return lists.join(directory, keys).select(key, (F.col("_cut") - F.col("_first")).alias("part"), "degree", name)


# A key is hot if it holds more than this share of all rows; so fewer keys than this are.
HOT_KEYS = 4096

# Rows of a key that a task may always get: a key of no more is not hot.
HOT_ROWS = 1024


def split_lookup(rows: DataFrame, table: DataFrame, key: str, weight: Column | str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` inner-joined with ``table`` (one row per ``key``) without gathering a hot key.

    ``weight`` is a column of ``table``: how many of ``rows`` have the key.  Keys with
    more than ``HOT_ROWS`` rows and ``1 / hot_keys`` of all rows are fewer than ``hot_keys``, whatever the data:
    these few table rows are broadcast, and their rows stay where they are.  All others
    are joined by a shuffle in which no key has more than that share.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    sums = table.agg(F.sum(w).alias("n"), F.max(w).alias("most")).first()
    bound = max((sums["n"] or 0) / hot_keys, HOT_ROWS)
    if (sums["most"] or 0) <= bound:
        return rows.join(table.where(w <= F.lit(bound)), key)
    hot = table.where(w > F.lit(bound))
    here = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return here.unionByName(rest.join(table.where(w <= F.lit(bound)), key))
