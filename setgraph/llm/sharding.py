"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Texts that are equal form a group and stay in one shard.  A partial partition is
a list of ``shards`` sets with their byte sums.  Differencing takes the two
partial partitions with the largest spread (largest sum less smallest) and
combines them in opposite orders, the heaviest set of one with the lightest of
the other, until one is left.

It runs in levels.  Groups are dealt to buckets of bounded size; each bucket is
differenced in its own task to one partial partition.  These are items of the
next level, dealt again to buckets, until one is left.  What a task holds is
bounded by the bucket, and the levels grow with the logarithm of the input.
Placements go back down as one small table (bucket, set -> set above) per level.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import dense_index
from .common import materialise, texts

SHARDS = 24
BUCKET_GROUPS = 20_000     # groups differenced in one task
BUCKET_PARTITIONS = 500    # partial partitions differenced in one task


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine the partial partitions in the rows of ``sums`` to one.

    Returns the final sums (descending) and, for each row and column, the final
    set that it went to.  Ties are taken in the order of the rows.
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    parts = [np.take_along_axis(sums[i:i + 1], order[i:i + 1], axis=1)[0] for i in range(n)]
    # nodes[i]: (left, right, order of the merged sets); a merged set j is left's j with right's k-1-j
    merged: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(p[0] - p[-1]), i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = parts[a] + parts[b][::-1]
        perm = np.argsort(-total, kind="stable")
        parts[a] = parts[b] = None
        parts.append(total[perm])
        merged.append((a, b, perm))
        heapq.heappush(heap, (-int(parts[-1][0] - parts[-1][-1]), n + len(merged) - 1))
    # from the root down: place[i][j] is the final set of the j-th heaviest set of node i
    place: list[np.ndarray | None] = [None] * (n + len(merged))
    place[-1] = np.arange(k)
    for i in range(n + len(merged) - 1, n - 1, -1):
        a, b, perm = merged[i - n]
        own = np.empty(k, dtype=np.int64)
        own[perm] = place[i]
        place[a], place[b], place[i] = own, own[::-1], None
    final = np.empty((n, k), dtype=np.int64)
    for i in range(n):
        final[i, order[i]] = place[i]
    return parts[-1], final


def _difference_groups(groups: DataFrame, buckets: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """First level.  ``g1, g2, bucket, part`` per group, and ``bucket, sums`` per bucket."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "g1", "g2"], ascending=[False, True, True], kind="stable")
        sums = np.zeros((len(pdf), shards), dtype=np.int64)
        sums[:, 0] = pdf["bytes"].to_numpy()
        _, place = difference(sums)
        return pd.DataFrame({"g1": pdf["g1"], "g2": pdf["g2"], "bytes": pdf["bytes"], "bucket": key[0], "part": place[:, 0]})

    placed = materialise(
        groups.withColumn("bucket", F.pmod(F.xxhash64("g2", "g1"), F.lit(buckets)))
        .groupBy("bucket").applyInPandas(run, "g1 long, g2 long, bytes long, bucket long, part long"))
    return placed.drop("bytes"), placed.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))


def _difference_buckets(sums: DataFrame, fan: int, shards: int) -> DataFrame:
    """One more level.  ``bucket, part, above, part_above, bytes`` from ``bucket, part, bytes``."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "part"])
        buckets, rows = np.unique(pdf["bucket"].to_numpy(), return_inverse=True)
        table = np.zeros((len(buckets), shards), dtype=np.int64)
        table[rows, pdf["part"].to_numpy()] = pdf["bytes"].to_numpy()
        _, place = difference(table)
        at = place[rows, pdf["part"].to_numpy()]
        return pd.DataFrame({"bucket": pdf["bucket"], "part": pdf["part"], "above": key[0], "part_above": at, "bytes": pdf["bytes"]})

    return materialise(
        sums.withColumn("above", F.floor(F.col("bucket") / F.lit(fan)).cast("long")).groupBy("above")
        .applyInPandas(run, "bucket long, part long, above long, part_above long, bytes long"))


def place_groups(groups: DataFrame, shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS,
                 bucket_partitions: int = BUCKET_PARTITIONS) -> DataFrame:
    """``g1, g2, shard`` for ``groups (g1, g2, bytes)``, the groups' sums as equal as
    differencing makes them."""
    buckets = max(1, -(-groups.count() // bucket_groups))
    placed, sums = _difference_groups(groups, buckets, shards)
    while buckets > 1:
        level = _difference_buckets(sums, bucket_partitions, shards)
        to = level.select(F.col("bucket").alias("b"), F.col("part").alias("p"), "above", "part_above")
        placed = placed.join(to, (F.col("bucket") == F.col("b")) & (F.col("part") == F.col("p"))).select(
            "g1", "g2", F.col("above").alias("bucket"), F.col("part_above").alias("part"))
        sums = level.groupBy(F.col("above").alias("bucket"), F.col("part_above").alias("part")).agg(F.sum("bytes").alias("bytes"))
        buckets = -(-buckets // bucket_partitions)
    return placed.select("g1", "g2", F.col("part").cast("int").alias("shard"))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, **bounds: int) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per document.

    ``size`` is the text's UTF-8 length (NULL: 0) plus 8; the shards' sums of sizes
    are made nearly equal, with equal texts (and all NULL ones) in one shard, so a
    group larger than an even share fills a shard of its own.  ``slot`` numbers a
    shard's rows from 0 in the order of ``doc_id`` (NULL first), without gaps.
    ``text_crc32`` of NULL is 0; ``grown_shard`` is NULL under this law.  Repeated
    rows are placed one by one.  Other columns are ignored.
    """
    text = F.col("text").cast("binary")
    rows = texts(docs).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text.isNull(), text).alias("g1"), F.xxhash64(F.lit("group"), text.isNull(), text).alias("g2"))
    rows = materialise(rows)
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"))
    placed = place_groups(groups, shards, **bounds)
    rows = rows.join(placed, ["g1", "g2"]).select("doc_id", "size", "text_crc32", "shard")
    ranked = dense_index(rows, "shard", "doc_id", "size", "text_crc32", name="place")
    starts = ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("shard").alias("of"), (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("start"))
    return ranked.join(F.broadcast(starts), F.col("shard") == F.col("of")).select(  # one row a shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
