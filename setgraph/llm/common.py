"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, share_package

# Rows of one Arrow batch.  Texts may be very long, so batches are small; the
# byte bound below cuts them further where Spark knows that setting.
BATCH_ROWS = 1000
BATCH_BYTES = 8 * 1024 * 1024

# Words of one shingle in every operator that compares texts by shingles.
SHINGLE_WORDS = 5

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of ``spark`` and keep adaptive execution on.

    Python workers import this package: its folder is added to their path, which
    serves local sessions and shared installations; a cluster without either
    gets the package by ``--py-files``."""
    share_package(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id LONG, text STRING``: all that the operators read of documents."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def crc_mod(doc_id: Column | str, m: int) -> Column:
    """``crc32(doc_id as text) mod m``; NULL for a NULL id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(m)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Rows made by ``fn`` from each Arrow batch: a dict of columns in the order
    of ``schema``.  ``fn`` keeps no state that results depend on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], names=list(out))

    return df.mapInArrow(run, schema)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    return reliable_checkpoint(df)


# Most bits of a key filter; its words, at most a 64th of these rows, are broadcast.
FILTER_BITS = 1 << 26


def key_filter(keys: DataFrame, *key: str) -> tuple[DataFrame, int]:
    """A bitmap of the hashes of ``keys``' keys, ``word_no, word``, and its size: 16 bits a
    row (so few others pass), up to ``FILTER_BITS``.  ``keys`` is read twice."""
    rows = keys.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    bits = min(FILTER_BITS, max(1 << 12, 1 << (16 * rows).bit_length()))
    at = F.pmod(F.xxhash64(*key), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    return keys.groupBy(F.floor(at / 64).cast("int").alias("word_no")).agg(F.bit_or(bit).alias("word")), bits


def may_hold(df: DataFrame, key: list[Column], words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose key may be among those of a :func:`key_filter`: all that
    are, and few others.  The join that follows is exact; this only keeps rows out of
    its shuffle."""
    at = F.pmod(F.xxhash64(*key), F.lit(bits))
    rows = df.withColumn(fresh(df, "_at"), at)
    there = rows[rows.columns[-1]]
    return rows.join(F.broadcast(words), (F.floor(there / 64).cast("int") == words["word_no"])
                     & (F.getbit(words["word"], (there % 64).cast("int")) == 1), "left_semi").select(*df.columns)


class WordHashes(dict):
    """word bytes -> 64-bit hash, filled on demand and emptied when large."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHashes()


def finish(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective mixing of the bits)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the text's five-word shingles.

    A-Z are lower-cased; words are runs without ASCII white space (what
    ``bytes.split`` gives).  A text of fewer words has one shingle, the whole
    sequence; one without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=n)
    if n < SHINGLE_WORDS:
        return finish((h * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
    m = n - SHINGLE_WORDS + 1
    s = h[:m] * _FACTORS[0]
    for k in range(1, SHINGLE_WORDS):
        s += h[k:k + m] * _FACTORS[k]
    return np.unique(finish(s))


def digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set of sorted hashes."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per numpy array, without going through Python objects."""
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
