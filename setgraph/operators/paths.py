"""Single-target shortest paths as an iterated DataFrame plan.

Edges are reduced to the shortest per (src, dst), hub nodes are salted, and
the result is hash-partitioned by (dst, salt) and checkpointed once, so every
round shuffles only the frontier.  Each round:

    frontier  x  edges(dst = frontier node)     -> candidate (d + w, h + 1, via)
    candidates  -> min per node                 (partial aggregate, map side)
    best  x  base, deltas (same partitioning)   -> improved nodes = this round's delta

The state is a base table of all nodes and one delta per round, so what a round
writes follows the nodes that it improves.  Many deltas are merged to one, and the
base is written anew when the deltas have half its rows.  With a distance bucket only
the improved nodes of the nearest bucket are relaxed, the others wait.  With a
state folder every round is durable: a new driver goes on after the last one.

The state keeps, per node, the lexicographically least ``(dist, hops, next)``
over all paths to the target, which makes ties deterministic and keeps the
``next`` pointers acyclic even with zero-weight cycles.  Paths are assembled
by pointer jumping: ``ceil(log2(max_hops + 1))`` self-joins instead of one
join per hop.  Lineage is cut by reliable checkpoints in the session's
checkpoint folder.
"""

from __future__ import annotations

import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, in_session, partitioned_checkpoint, static_session
from ..session import reliable_checkpoint as _checkpoint

# In-edges per salt bucket of a node.  A hub with d in-edges is split into
# ceil(d / SALT_EDGES) buckets, each joined by its own task; its frontier row
# is replicated once per bucket.
SALT_EDGES = 1 << 18


def prepare_edges(edges: DataFrame, salt_edges: int = SALT_EDGES) -> tuple[DataFrame, DataFrame]:
    """Validated, min-reduced, salted edges and the per-node salt counts.

    Returns ``(edges(dst, salt, src, w), salts(node, salts))`` as DataFrames of a
    static session; ``edges`` is hash-partitioned by ``(dst, salt)`` and
    checkpointed, and ``salts`` is read from it.
    """
    spark = edges.sparkSession
    w, ends = F.col("dist"), F.col("src").isNull() | F.col("dst").isNull()
    bad = w.isNull() | F.isnan(w) | (w < 0)
    e = edges.select(
        F.when(ends, F.raise_error(F.lit("edge ends must not be null"))).otherwise(F.col("src").cast("long")).alias("src"),
        F.when(ends, F.lit(None)).otherwise(F.col("dst").cast("long")).alias("dst"),
        F.when(bad, F.raise_error(F.lit("edge weights must be non-negative numbers")))
        .otherwise(w.cast("double")).alias("w"))
    e = _checkpoint(e.groupBy("src", "dst").agg(F.min("w").alias("w")))
    # only hubs are salted: the join's small side has one row per hub, not per node
    hubs = _checkpoint(e.groupBy("dst").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_edges)).cast("int").alias("_salts")).where("_salts > 1"))
    if hubs.isEmpty():
        e = e.withColumn("salts", F.lit(1))
    else:
        e = e.join(hubs, "dst", "left").withColumn("salts", F.coalesce("_salts", F.lit(1)))
    e = e.withColumn("salt", F.pmod(F.xxhash64("src"), F.col("salts")).cast("int")).select("dst", "salt", "src", "w", "salts")
    if not hubs.isEmpty():
        # the skewed join runs adaptively
        e = _checkpoint(e)
    # laid out once by (dst, salt) so that every round joins it without shuffling it
    own = static_session(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = partitioned_checkpoint(in_session(e, own).repartition(n, "dst", "salt"))
    return e.drop("salts"), e.groupBy(F.col("dst").alias("node")).agg(F.max("salts").alias("salts"))


# Most deltas of the state; beyond, they are merged to one.
DELTAS = 3


def _candidates(frontier: DataFrame, e: DataFrame) -> DataFrame:
    """``node, nc``: the best way to each node over one edge into the frontier."""
    f = frontier.select(F.col("node").alias("v"), F.col("c").alias("vc"),
                        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("vsalt"))
    # hash joins built from the small sides (frontier, best candidates: at most
    # one row per node and salt) stream the edges and the state without
    # sorting them
    cand = e.join(f.hint("shuffle_hash"), (f.v == e.dst) & (f.vsalt == e.salt)).select(
        F.col("src").alias("node"),
        # distance accumulates target-outward: dist(next) + w
        F.struct((F.col("vc.d") + F.col("w")).alias("d"), (F.col("vc.h") + 1).alias("h"),
                 F.col("v").alias("nx")).alias("nc"))
    return cand.groupBy("node").agg(F.min("nc").alias("nc"))


def _latest(base: DataFrame, deltas: list[DataFrame]) -> DataFrame:
    """``node, c, salts`` with the latest value of each node of ``base``; the deltas are joined
    where they lie."""
    out = base
    for k, delta in enumerate(deltas):
        out = out.join(delta.select("node", F.col("c").alias(f"c{k}")).hint("shuffle_hash"), "node", "left")
    names = [f"c{k}" for k in reversed(range(len(deltas)))] + ["c"]
    others = [c for c in base.columns if c not in ("node", "c", "salts")]
    return out.select("node", F.coalesce(*names).alias("c"), "salts", *others)


def _relax(base: DataFrame, deltas: list[DataFrame], frontier: DataFrame, e: DataFrame) -> DataFrame:
    """One round: ``node, c, salts`` of the nodes that the frontier improves.

    A round shuffles the frontier and the partially aggregated candidates; edges
    stay partitioned by (dst, salt), base and deltas by node."""
    best = _candidates(frontier, e)
    at = _latest(base.join(best.hint("shuffle_hash"), "node"), deltas)
    better = at.where(F.col("c").isNull() | (F.col("nc") < F.col("c")))
    return better.select("node", F.col("nc").alias("c"), "salts")


def _from_files(df: DataFrame, folder: str, *keys: str) -> DataFrame:
    """``df`` written to ``folder`` (overwritten) and read again, laid out by ``keys`` if there are any.

    The planner takes a join for as large as the product of its sides, and a checkpoint
    keeps that estimate.  Tables that are joined with one another round after round would
    get estimates whose digits double with the rounds, until the driver has no time or memory
    for them; what is read from files has the files' size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("overwrite").parquet(folder)
    out = df.sparkSession.read.parquet(folder)
    return partitioned_checkpoint(out.repartition(n, *keys)) if keys else out


class _Rounds:
    """Tables of a run in a shared folder: what a round made, and a manifest row that is
    written after it.  Tables without a manifest row are those of a driver that was
    lost; they are overwritten."""

    MANIFEST = "round long, target long, base string, deltas array<string>, waiting string, base_rows long, delta_rows long, nearest double, open long"

    def __init__(self, session: SparkSession, folder: str, target: int):
        self.session, self.folder, self.target = session, folder.rstrip("/"), target

    def last(self):
        """The manifest row of the last whole round, None if there is none."""
        try:
            rows = self.session.read.schema(self.MANIFEST).json(f"{self.folder}/manifest/*")
            row = rows.orderBy(F.col("round").desc()).first()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        if row is not None and row["target"] != self.target:
            raise ValueError(f"{self.folder} holds rounds for target {row['target']}, not {self.target}")
        return row

    def save(self, name: str, df: DataFrame) -> str:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return name

    def load(self, name: str, *keys: str) -> DataFrame:
        """A table, laid out by its keys again."""
        n = int(self.session.conf.get("spark.sql.shuffle.partitions"))
        return partitioned_checkpoint(self.session.read.parquet(f"{self.folder}/{name}").repartition(n, *keys))

    def commit(self, **row: object) -> None:
        row = {"target": self.target, **row}
        names = [f.split()[0] for f in self.MANIFEST.split(", ")]
        self.session.createDataFrame([tuple(row[n] for n in names)], self.MANIFEST).coalesce(1).write.mode("overwrite").json(
            f"{self.folder}/manifest/{row['round']:06d}")


def shortest_distances(edges: DataFrame, target: int, salt_edges: int = SALT_EDGES,
                       bucket: float | None = None, state_dir: str | None = None) -> DataFrame:
    """``node LONG, c STRUCT<d DOUBLE, h INT, nx LONG>`` for every node that reaches
    ``target``; ``d`` is the distance, ``h`` the hop count, ``nx`` the next node.

    ``bucket`` is the width of the distance buckets that are relaxed one after the other
    (none: every improved node at once).  ``state_dir``, a folder on shared storage, keeps
    every round; a call on the same folder goes on from the last whole one."""
    spark = edges.sparkSession
    own = static_session(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = _Rounds(own, state_dir, target) if state_dir else None
    folder = f"{checkpoint_dir(spark).rstrip('/')}/paths-{uuid.uuid4().hex}"
    row = kept.last() if kept else None
    if row is not None:
        e = kept.load("edges", "dst", "salt")
        base, deltas = kept.load(row["base"], "node"), [kept.load(d, "node") for d in row["deltas"]]
        waiting = kept.load(row["waiting"], "node")
        k, base_rows, delta_rows, nearest, open_ = (row[c] for c in ("round", "base_rows", "delta_rows", "nearest", "open"))
        names = (row["base"], list(row["deltas"]))
    else:
        e, salts = prepare_edges(edges, salt_edges)
        own = e.sparkSession
        # the base holds every node from the start (unreached: c = NULL)
        nodes = e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node"))).distinct()
        # the target starts at 0 only if some edge ends there
        start = (F.col("node") == F.lit(target)) & F.col("salts").isNotNull()
        zero = F.struct(F.lit(0.0).alias("d"), F.lit(0).alias("h"), F.lit(None).cast("long").alias("nx"))
        seen = Observation(f"sp-base-{uuid.uuid4().hex}")
        base = nodes.join(salts, "node", "left").select("node", F.when(start, zero).alias("c"), F.coalesce("salts", F.lit(1)).alias("salts"))
        base = partitioned_checkpoint(base.repartition(n, "node").observe(seen, F.count(F.lit(1)).alias("rows")))
        deltas, waiting = [], base.where(F.col("c").isNotNull())
        k, base_rows, delta_rows, nearest, open_ = 0, seen.get["rows"], 0, 0.0, 1
        names = ("base-000000", [])
        if kept:
            kept.session = own
            kept.save("edges", e)
            kept.save("base-000000", base)
            kept.commit(round=0, base=names[0], deltas=[], waiting=kept.save("waiting-000000", waiting),
                        base_rows=base_rows, delta_rows=0, nearest=0.0, open=1)
    counts = [F.count(F.lit(1)).alias("rows"), F.min("c.d").alias("nearest")]
    while open_:
        k += 1
        bound = math.inf if bucket is None else (math.floor(nearest / bucket) + 1) * bucket
        near, far = (waiting, None) if bucket is None else (waiting.where(F.col("c.d") < bound), waiting.where(F.col("c.d") >= bound))
        seen = Observation(f"sp-round-{uuid.uuid4().hex}")
        delta = partitioned_checkpoint(_relax(base, deltas, near, e).observe(seen, *counts))
        improved, nearest = seen.get["rows"], seen.get["nearest"]
        open_, waiting = improved, delta
        if far is not None:     # what waits and was not improved again, and the improved nodes
            seen = Observation(f"sp-waiting-{uuid.uuid4().hex}")
            rest = far.join(delta.select("node"), "node", "left_anti")
            waiting = partitioned_checkpoint(rest.unionByName(delta).observe(seen, *counts))
            open_, nearest = seen.get["rows"], seen.get["nearest"]
        if improved:
            deltas, delta_rows = [*deltas, delta], delta_rows + improved
            names[1].append(f"delta-{k:06d}")
            if kept:
                kept.save(names[1][-1], delta)
            if 2 * delta_rows > base_rows:
                base, deltas, delta_rows = _from_files(_latest(base, deltas), f"{folder}/base", "node"), [], 0
                waiting = _from_files(waiting, f"{folder}/waiting")
                names = (f"base-{k:06d}", [])
                if kept:
                    kept.save(names[0], base)
            elif len(deltas) > DELTAS:
                merged = deltas[0]
                for d in deltas[1:]:
                    merged = merged.unionByName(d)
                # a node's values only ever fall, so the least is the latest
                merged = merged.groupBy("node", "salts").agg(F.min("c").alias("c")).select("node", "c", "salts")
                deltas = [_from_files(merged, f"{folder}/deltas", "node")]
                waiting = _from_files(waiting, f"{folder}/waiting")
                names = (names[0], [f"deltas-{k:06d}"])
                if kept:
                    kept.save(names[1][0], deltas[0])
        if kept:
            at = names[1][-1] if bucket is None and names[1] and names[1][-1] == f"delta-{k:06d}" else kept.save(f"waiting-{k:06d}", waiting)
            kept.commit(round=k, base=names[0], deltas=names[1], waiting=at, base_rows=base_rows, delta_rows=delta_rows,
                        nearest=float(nearest or 0.0), open=open_)
    _latest(base, deltas).where(F.col("c").isNotNull()).select("node", "c").write.parquet(f"{folder}/dist")
    return spark.read.parquet(f"{folder}/dist")


def assemble_paths(dist: DataFrame) -> DataFrame:
    """``node, path ARRAY<LONG>`` (node ... target) by pointer jumping over ``c.nx``.

    A node's segment ends before ``end``.  Each step appends the segment of ``end``
    to the open rows; rows that have reached the target are set aside and only
    joined to.  Many rows may wait for the same end, which is one row of the
    other side; AQE splits such a key.
    """
    max_h = dist.agg(F.max("c.h")).first()[0] or 0
    p = dist.select("node", F.array("node").alias("seg"), F.col("c.nx").alias("end"))
    done, open_ = p.where("end IS NULL"), p.where("end IS NOT NULL")
    for _ in range(math.ceil(math.log2(max_h + 1)) if max_h > 0 else 0):
        a, b = open_.alias("a"), done.unionByName(open_).alias("b")
        new = _checkpoint(a.join(b, F.col("a.end") == F.col("b.node")).select(
            F.col("a.node").alias("node"), F.concat("a.seg", "b.seg").alias("seg"), F.col("b.end").alias("end")))
        done, open_ = done.unionByName(new.where("end IS NULL")), new.where("end IS NOT NULL")
    return done.select("node", F.col("seg").alias("path"))


def shortest_paths_to(edges: DataFrame, target: int, with_path: bool = True,
                      salt_edges: int = SALT_EDGES, bucket: float | None = None,
                      state_dir: str | None = None) -> DataFrame:
    """Shortest path from every node to ``target``.

    ``edges(src, dst, dist)`` with ``dist >= 0`` (a negative, NaN or NULL weight and
    a NULL end raise).  Output ``node LONG, dist DOUBLE, hops INT[, path ARRAY<LONG>]``;
    nodes that cannot reach the target have no row, and the target has a row
    only if it is the end of some edge.  Among equally short paths the one
    with fewer hops, then the smaller next node, is taken.  ``bucket`` and ``state_dir``
    as in :func:`shortest_distances`.
    """
    d = shortest_distances(edges, target, salt_edges, bucket, state_dir)
    out = d.select("node", F.col("c.d").alias("dist"), F.col("c.h").alias("hops"))
    if not with_path:
        return out
    return out.join(assemble_paths(d), "node")
