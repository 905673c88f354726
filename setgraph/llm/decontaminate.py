"""Benchmark decontamination by size-partitioned MinHash containment search.

An item of q shingles inside a document of n >> q has a containment near 1 but a
Jaccard similarity near q / n, so one banding cannot serve all documents.  The
documents are therefore partitioned by the size class of their shingle sets
(powers of two).  In the class with upper bound u a containment c of an item
means a similarity of at least c q / (u + q - c q); bands of one row keep such
low similarities, and the number of coordinates of a (class, item class) pair is
chosen so that an item reaching the containment is missed with a probability
below ``MISS``.  Sketches are one-permutation MinHashes: hashed bins, each with
the least hash of the set that falls into it.  Classes that would need more bins
than pay off use every hash as its own coordinate, which misses nothing.

A document can share a coordinate with an item only through a shared shingle.  A
Bloom filter of fixed size over the items' shingles, sent to every task, tells
which documents need sketches at all; its false positives cost work, not results.
Candidates are verified by exact containment of the full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, finish, fresh, list_array, map_arrow, materialise, shingles, texts

PERCENT = 75          # least containment of an item, in hundredths
MISS = 1e-6           # bound of the probability that sketches miss a contained item
FILTER_BITS = 1 << 23  # of the Bloom filter: 1 MB, whatever the size of the benchmark
MAX_CLASS = 31        # size classes of documents: a text has less than 2^31 words

_BIN = np.uint64(0x9E3779B97F4A7C15)


def size_class(n: int) -> int:
    """c with 2^(c-1) < n <= 2^c."""
    return int(n - 1).bit_length()


def coordinates(doc_class: int, item_class: int) -> int:
    """Bins for documents of one class against items of another; 0: every hash.

    Of an item's q shingles at least 0.75 q are in the document.  Each is the
    document's least in its bin with a probability of at least exp(-u / m), and
    the item's with at least exp(-q / m); with all independent, none of them is
    with (1 - p)^(0.75 q) at most.
    """
    u, q = 2 ** doc_class, 2 ** item_class // 2 + 1
    hits = -(-q * PERCENT // 100)
    need = 1.0 - MISS ** (1.0 / hits)  # chance that one shared shingle makes an equal coordinate
    # the least m with exp(-(u + 2q) / m) >= need
    if need >= 0.99:
        return 0
    m = int(np.ceil(-(u + 2 * q) / np.log(need)))
    return 0 if m >= 4 * u else m


def sketch_keys(hashes: np.ndarray, doc_class: int, item_class: int) -> np.ndarray:
    """The coordinates of a sorted set of hashes as 64-bit keys (class, bin, least hash)."""
    m = coordinates(doc_class, item_class)
    if m:
        bins = finish(hashes * _BIN) % np.uint64(m)
        _, first = np.unique(bins, return_index=True)  # the hashes are sorted: the first is the least
        hashes = hashes[first]
    return finish(hashes + np.full(1, doc_class * 64 + item_class, np.uint64) * _BIN).view(np.int64)


def _bit_places(hashes: np.ndarray) -> np.ndarray:
    h = finish(hashes)
    bits = np.uint64(FILTER_BITS - 1)
    return np.stack([h & bits, (h >> np.uint64(32)) & bits]).astype(np.int64)


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_size, node BINARY, item ARRAY<LONG>``: the shingle set of every
    item that has one, and its digest."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        return {"item_id": batch.column("item_id"), "item_size": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([digest(s) for s in sets], pa.binary()),
                "item": list_array([s.view(np.int64) for s in sets], pa.int64())}

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "item_id long, item_size long, node binary, item array<long>").where("item_size > 0")


def _filter(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The Bloom filter of all items' shingles and the size classes of the items.

    Each task makes its part of the filter; the parts are merged by words of 64
    bits on the executors.  What reaches the driver is bounded by FILTER_BITS."""

    def run(batch: pa.RecordBatch) -> dict:
        lists = batch.column("item")
        places = np.unique(_bit_places(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)))
        words, starts = np.unique(places >> 6, return_index=True)
        bits = np.left_shift(np.uint64(1), (places & 63).astype(np.uint64))
        sizes = np.unique(batch.column("item_size").to_numpy(zero_copy_only=False))
        classes = sorted({size_class(int(n)) for n in sizes})
        return {"word": pa.array(np.concatenate([words, [-1 - c for c in classes]]).astype(np.int64)),
                "bits": pa.array(np.concatenate([np.bitwise_or.reduceat(bits, starts).view(np.int64),
                                                 np.zeros(len(classes), np.int64)]))}

    merged = map_arrow(items, run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    real = merged[merged["word"] >= 0]
    table[real["word"].to_numpy(dtype=np.int64)] = real["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return table, sorted(int(-1 - w) for w in merged.loc[merged["word"] < 0, "word"])


def _candidates(docs: DataFrame, table: np.ndarray, classes: list[int]) -> DataFrame:
    """``doc_id, mark, hits, keys``: documents with a shingle that may be an item's,
    those shingles, and those coordinates of their sketches that carry one."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batch: pa.RecordBatch) -> dict:
        bits, rows, hits, keys = shared.value, [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            s = shingles(text)
            if not len(s):
                continue
            p = _bit_places(s)
            hit = ((bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).all(axis=0)
            if not hit.any():
                continue
            found, c = s[hit], size_class(len(s))
            rows.append(i)
            hits.append(found.view(np.int64))
            # a coordinate that holds another shingle cannot equal an item's
            keys.append(np.unique(np.concatenate([
                np.intersect1d(sketch_keys(s, c, k), sketch_keys(found, c, k)) for k in classes])))
        place = pa.array(rows, pa.int64())
        return {"doc_id": batch.column("doc_id").take(place), "mark": batch.column("mark").take(place),
                "hits": list_array(hits, pa.int64()), "keys": list_array(keys, pa.int64())}

    rows = texts(docs).withColumn("mark", F.xxhash64("text"))
    return map_arrow(rows, run, "doc_id long, mark long, hits array<long>, keys array<long>")


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment``: every document and item
    where the document holds 75 % or more of the item's distinct five-word shingles.

    Items without words match nothing; an item of fewer than five words is one
    shingle and matches only documents of just these words.  Rows that repeat an
    id and text give one row.  NULL ids are carried as such.  Other columns are
    ignored.
    """
    return _matches(docs, benchmark).select("doc_id", "item_id", "n_shared", "n_item", "containment")


def _matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = materialise(_items(benchmark))
    table, classes = _filter(items)
    # Copies of an item have equal sets: candidates meet one of them.
    kinds = items.select("node", "item").dropDuplicates(["node"])

    def run(batch: pa.RecordBatch) -> dict:
        sets = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in batch.column("item").to_pylist()]
        rows, keys = [], []
        for i, s in enumerate(sets):
            k = size_class(len(s))
            for c in range(MAX_CLASS + 1):
                own = sketch_keys(s, c, k)
                rows.append(np.full(len(own), i))
                keys.append(own)
        place = pa.array(np.concatenate(rows))
        return {"key": pa.array(np.concatenate(keys)), "node": batch.column("node").take(place)}

    item_keys = map_arrow(kinds, run, "key long, node binary")
    found = materialise(_candidates(docs, table, classes))
    pairs = found.select("doc_id", "mark", F.explode("keys").alias("key")).join(item_keys, "key").select(
        "doc_id", "mark", "node").distinct()
    hits = found.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "hits").dropDuplicates(["d", "m"])
    both = pairs.join(kinds, "node").join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("mark").eqNullSafe(F.col("m")))
    n_item, n_shared = F.size("item").cast("long"), F.size(F.array_intersect("item", "hits")).cast("long")
    held = both.select("doc_id", "mark", "node", n_shared.alias("n_shared"), n_item.alias("n_item")).where(
        100 * F.col("n_shared") >= PERCENT * F.col("n_item"))
    return held.join(items.select("item_id", "node"), "node").select(
        "doc_id", "mark", "item_id", "n_shared", "n_item",
        (F.col("n_shared").cast("double") / F.col("n_item").cast("double")).alias("containment")).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`contaminations` finds."""
    mark = fresh(docs, "text_mark")
    bad = _matches(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct()
    rows = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    return rows.join(bad, F.col("doc_id").cast("long").eqNullSafe(bad["bad_id"]) & (rows[mark] == bad["bad_mark"]),
                     "left_anti").drop(mark)
