"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch.  ``COORDS`` coordinates are filled in rounds.  In round i < COORDS every
shingle is thrown into one hashed bin with the value i + u (u hashed, 0 <= u < 1);
in round COORDS + j every shingle goes to bin j.  A bin keeps its least value and
the rounds end when every bin is filled, so each coordinate gets a value however
small the set is.  Two sketches agree in a coordinate with a probability equal to
the sets' Jaccard similarity, with concentration like independent hashing.

Banding.  ``BANDS`` bands of ``ROWS`` coordinates make the candidates; a pair at
similarity 0.75 shares no band with probability (1 - 0.75^4)^32 < 6e-6.

Verification is exact, on the full shingle sets.  Equal sets are collapsed first.
A large group of near copies must not make all its pairs, and no link may be
lost, so bands are settled in steps:

1. Every member of a band is compared with the band's most connected member, and
   members that miss it with the most connected one of them.
2. Only bands whose members still lie in several components can hold open links.
   Their members are joined exactly by prefix filtering: with the shingles in
   order of their frequency, two linked sets share one among the first n -
   ceil(3 n / 4) + 1 of each.  Copies with unrelated edits have their own shingles
   there and never meet.  Members of a shingle's most frequent component meet
   only those of other components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, finish, list_array, map_arrow, materialise, shingles, texts
from .components import components

COORDS = 128
ROWS = 4
BANDS = COORDS // ROWS
PERCENT = 75  # least similarity of linked documents, in hundredths

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def sketch(hashes: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """``coords`` values of a set of hashes (uint64): round in the high 16 bits,
    hashed fraction in the others."""
    out = np.full(coords, np.iinfo(np.uint64).max, dtype=np.uint64)
    n = len(hashes)
    if not n:
        return out
    step = max(1, int(1.3 * coords * np.log(coords)) // n + 1)  # rounds at once: enough, as a rule, to fill all bins
    first = 0
    while first < coords:
        rounds = np.arange(first, min(first + step, coords), dtype=np.uint64)
        x = finish((hashes[None, :] + (rounds[:, None] + np.uint64(1)) * _GOLD).ravel())
        bins = (x >> np.uint64(40)) % np.uint64(coords)
        value = (np.repeat(rounds, n) << np.uint64(48)) | (finish(x) >> np.uint64(16))
        np.minimum.at(out, bins.astype(np.intp), value)
        if out.max() != np.iinfo(np.uint64).max:
            return out
        first += step
    for j in np.flatnonzero(out == np.iinfo(np.uint64).max):  # the rounds that fill a given bin
        x = finish(finish(hashes + np.full(1, coords + j + 1, np.uint64) * _GOLD)) >> np.uint64(16)
        out[j] = (np.uint64(coords + j) << np.uint64(48)) | x.min()
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of the key)."""
    rows = values.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = finish(key * _GOLD + rows[:, k])
    return key


def sketches(docs: DataFrame, marked: bool = False) -> DataFrame:
    """``doc_id, n_shingles, node BINARY, bands ARRAY<LONG>[, mark]``; ``node`` is a digest
    of the shingle set, NULL where it is empty, ``mark`` a hash of the text."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        keys = [band_keys(sketch(s)).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
        return {"doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                "bands": list_array(keys, pa.int64()), **({"mark": batch.column("mark")} if marked else {})}

    rows = texts(docs).withColumn("mark", F.xxhash64("text")) if marked else texts(docs)
    return map_arrow(rows, run, "doc_id long, n_shingles long, node binary, bands array<long>" + ", mark long" * marked)


def _with_texts(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    left = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")


class _Sets(dict):
    """text -> shingles, for the texts of one batch."""

    def __missing__(self, text: str) -> np.ndarray:
        s = self[text] = shingles(text)
        return s


def _verify(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets have the similarity."""

    def run(batch: pa.RecordBatch) -> dict:
        sets, keep = _Sets(), []
        for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(sets[x]) + len(sets[y]) - both))
        mask = pa.array(keep, pa.bool_())
        return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}

    return map_arrow(_with_texts(pairs, bodies), run, "a binary, b binary")


def _open_pairs(rows: DataFrame, roots: DataFrame, bodies: DataFrame) -> DataFrame:
    """Step 2: the pairs of different components that prefixes leave, for the members
    of bands with several components."""
    placed = rows.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("band")
    members = placed.join(mixed, "band", "left_semi").select("node", "root").distinct()

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        return {"node": batch.column("node"), "root": batch.column("root"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "shingles": list_array([s.view(np.int64) for s in sets], pa.int64())}

    sets = map_arrow(members.join(bodies, "node"), run, "node binary, root binary, n long, shingles array<long>")
    held = materialise(sets.select("node", "root", "n", F.explode("shingles").alias("shingle")))
    # shingles of one set only come first in the order and join nothing
    common = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    ordered = held.join(common, "shingle").groupBy("node", "root", "n").agg(
        F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("s"))
    ordered = ordered.withColumn("alone", F.col("n") - F.size("s"))
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100)) + 1
    prefix = F.greatest(F.lit(0), prefix - F.col("alone")).cast("int")
    short = materialise(
        ordered.select("node", "root", "n", "alone", F.posexplode(F.slice("s", 1, prefix)).alias("at", "e"))
        .select("node", "root", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"), F.col("e.shingle").alias("shingle")))
    by_root = short.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("k"))
    most = by_root.groupBy("shingle").agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    most = most.select("shingle", F.col("top.root").alias("top"))
    every = short.join(most, "shingle")
    other = every.where(F.col("root") != F.col("top")).select(
        F.col("shingle").alias("shingle_x"), F.col("node").alias("x"), F.col("root").alias("root_x"), F.col("n").alias("n_x"),
        F.col("left").alias("left_x"))
    # what can still be shared from this shingle on, against 100 k >= 75 (n + n_x - k)
    enough = (100 + PERCENT) * F.least("left", "left_x") >= PERCENT * (F.col("n") + F.col("n_x"))
    return every.join(other, (F.col("shingle") == F.col("shingle_x")) & (F.col("root") != F.col("root_x")) & enough).select(
        F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()


def _bodies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` for ``wanted (node, doc_id)``.  Rows that repeat an id with
    another text are told apart by the digest."""
    d = texts(docs)
    w = wanted.select("node", F.col("doc_id").alias("id"))

    def run(batch: pa.RecordBatch) -> dict:
        mask = pa.array([digest(shingles(t)) == k for t, k in
                         zip(batch.column("text").to_pylist(), batch.column("node").to_pylist())], pa.bool_())
        return {c: batch.column(c).filter(mask) for c in ("node", "text")}

    found = map_arrow(d.join(w, d["doc_id"].eqNullSafe(w["id"])).select("node", "text"), run, "node binary, text string")
    return materialise(found.dropDuplicates(["node"]))


def _hubs(rows: DataFrame) -> DataFrame:
    """``band, hub``: the member of the highest degree of each band."""
    return rows.groupBy("band").agg(F.max(F.struct("degree", "node")).alias("h")).select("band", F.col("h.node").alias("hub"))


def _star(rows: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of the bands' members with their bands' hubs."""
    return rows.join(_hubs(rows), "band").where(F.col("node") != F.col("hub")).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document.

    Documents are linked at a Jaccard similarity of 0.75 or more of their
    five-word shingle sets; ``component_id`` is the least id reachable over
    links and ``kept`` says that the document has that id.  Documents without
    words (NULL, empty, white space) are linked with nothing and kept.  Rows
    that repeat an id and text give equal rows.  NULL ids are linked like others,
    never the least id beside a known one.  Other columns are ignored.
    """
    base = materialise(sketches(docs))
    return _settle(base, *_linked(docs, base))


def _linked(docs: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sets ``node, n_shingles, doc_id, bands`` and the roots ``node, root``
    of those with links."""
    nodes = materialise(
        base.where(F.col("node").isNotNull()).groupBy("node", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")))
    rows = nodes.select("node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = materialise(rows.join(shared, "band"))
    # The most connected member of a band, by the sizes of all its bands: the
    # original among copies that are each altered elsewhere.
    degree = rows.groupBy("node").agg(F.sum(F.col("size") - 1).alias("degree"))
    rows = materialise(rows.join(degree, "node").select("band", "node", "degree"))
    bodies = _bodies(docs, rows.select("node").distinct().join(nodes.select("node", "doc_id"), "node"))
    first = _star(rows)
    links = materialise(_verify(first, bodies))
    missed = rows.join(_hubs(rows), "band").where(F.col("node") != F.col("hub")).select(
        "band", "node", "degree", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    missed = materialise(missed.join(links, ["a", "b"], "left_anti").select("band", "node", "degree"))
    links = materialise(links.unionByName(_verify(_star(missed), bodies)))
    rest = _verify(_open_pairs(rows, components(links), bodies), bodies)
    return nodes, components(links.unionByName(rest))


def _settle(base: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Component ids of all documents from the roots of their sets."""
    of = nodes.select("node", "doc_id").join(roots, "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = of.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of.join(least, "root").select(F.col("node").alias("named"), "component_id")
    out = base.join(named, F.col("node") == F.col("named"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the least id, known ones first, and
    of texts under one id that of the least hash.  Rows that repeat an id and text are
    one document, of which the row of the least hash stays, also where it has no words."""
    base = materialise(sketches(docs, marked=True))
    _, roots = _linked(docs, base)
    # NULL ids by a flag, so that the joins are plain ones
    place = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "mark"]
    least = base.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct(*place)).alias("least"))
    least = least.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    kept = least.select("least.*").unionByName(base.where(F.col("node").isNull()).select(*place).distinct())
    # repeated rows meet in a partial aggregation before they are moved; which of them stays is
    # told by a hash of their other columns, whatever their types
    row = F.struct(*[F.col(c) for c in docs.columns if c != "text"], F.col("text"))
    others = F.to_json(F.struct(F.lit(0).alias("none"), *[F.col(c) for c in docs.columns if c != "text"]))
    d = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                    F.xxhash64(F.col("text").cast("string")).alias("mark"), row.alias("row"), F.xxhash64(others).alias("which"))
    d = d.groupBy("no_id", "id", "mark").agg(F.min_by("row", "which").alias("row"))
    return d.join(kept, ["no_id", "id", "mark"], "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])
