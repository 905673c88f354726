"""Hard negatives by Fagin's threshold algorithm over integer embeddings.

A row's score for an anchor is the integer inner product of their quantised
vectors.  An anchor's positives are its best rows of the same label; a hard
negative of (anchor, positive) is one of the best rows of another label whose
score lies in a window below the positive's score.

Rows are dealt to blocks of bounded size, anchors to groups of bounded size, and a
task meets one block with one group.  A block keeps one list per dimension,
sorted by component.  For an anchor every list is read from its high end where
the anchor's component is positive and from its low end where it is negative
(sorted access); each row seen for the first time is scored in full from its
vector (random access).  No row unseen so far can score above the threshold, the
sum of the anchor's components times the values last read from the lists, so the
search stops once the threshold is strictly below the k-th best score of every
window (or below the window itself); strictly, because a tie is won by the
smaller id.  The blocks' best rows are merged by a ranking, of which Spark keeps
only the first k on either side of the shuffle.

Positives come first, from blocks of one label; their scores give the windows of
the second search, over blocks of all labels.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256            # a component x becomes floor(SCALE * x)
POSITIVES = 5          # positives of an anchor
NEGATIVES = 3          # negatives of an anchor and positive
WINDOW = (50, 95)      # a negative's score, in hundredths of the positive's
BLOCK = 4096           # rows of a block
ANCHORS = 1024         # anchors of a group
FIRST_DEPTH = 16       # entries read from each list in the first round; doubled from round to round

LEAST, MOST = -(2 ** 63), 2 ** 63 - 1


class Lists:
    """The rows of one block and, per dimension, their order by component."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray], width: int):
        order = np.argsort(ids, kind="stable")      # row numbers follow the ids, which decide ties
        self.ids = ids[order]
        self.rows = order
        self.x = np.zeros((len(ids), width), dtype=np.int64)
        for i, k in enumerate(order):
            self.x[i, :len(vectors[k])] = vectors[k]
        self.most = int(np.abs(self.x.astype(np.float64)).max()) + 1 if self.x.size else 1
        self.order = np.argsort(self.x, axis=0, kind="stable").T.copy()     # dimension x place
        self.values = np.take_along_axis(self.x.T, self.order, axis=1)
        self.wide: np.ndarray | None = None         # Python integers, made where a score may pass 64 bits

    def _scoring(self, anchor: np.ndarray, dims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors and the anchor's components to score with: 64-bit integers, or Python's
        where a score might not fit."""
        a = anchor[dims]
        if int(np.abs(a.astype(np.float64)).sum() * self.most) < 2 ** 62:
            return self.x, a
        if self.wide is None:
            self.wide = self.x.astype(object)
        return self.wide, a.astype(object)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float]], k: int) -> tuple[list[np.ndarray], np.ndarray, int]:
        """For each window (lowest, highest score) the numbers of its first ``k`` allowed rows
        by (score descending, id); the scores of the rows seen; and the number of those."""
        n, dims = len(self.ids), np.flatnonzero(anchor)
        x, a = self._scoring(anchor, dims)
        down = anchor[dims] > 0
        scores = np.zeros(n, dtype=a.dtype)
        seen = np.zeros(n, dtype=bool)
        best = [np.empty(0, dtype=np.int64)] * len(windows)
        at, depth = 0, FIRST_DEPTH
        while at < n and not seen.all():
            # sorted access: from a list's high end for a positive component, else from its low end
            end = min(n, at + depth) if len(dims) else n
            mark = np.zeros(n, dtype=bool)
            mark[self.order[dims[down], n - end:n - at].ravel()] = True
            mark[self.order[dims[~down], at:end].ravel()] = True
            new = np.flatnonzero(mark & ~seen) if len(dims) else np.arange(n)   # a zero anchor scores all rows 0
            seen[new] = True
            # random access: score the rows seen for the first time
            scores[new] = x[new][:, dims] @ a
            fit = new[allowed[new]]
            for w, (low, high) in enumerate(windows):
                inside = fit[(scores[fit] >= low) & (scores[fit] <= high)]
                if len(inside):
                    both = np.concatenate([best[w], inside])
                    best[w] = both[np.lexsort((both, -scores[both]))[:k]]
            at, depth = end, depth * 2
            last = np.where(down, self.values[dims, n - at], self.values[dims, at - 1])
            threshold = (last.astype(a.dtype) * a).sum()
            if all(threshold < low or (len(found) == k and threshold < scores[found[-1]]) for (low, _), found in zip(windows, best)):
                break
        return best, scores, int(seen.sum())


def window_of(positive: int, window: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """Lowest and highest score s with ``low * positive <= 100 * s <= high * positive``."""
    low, high = window
    return -((-low * positive) // 100), (high * positive) // 100


def usable_rows(embeddings: DataFrame, vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``row, vec_id, label, x ARRAY<LONG>``: the rows that take part, quantised, each
    with a number of its own."""
    e = F.col(vec)
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & ~bad)
    x = F.transform("e", lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))
    return materialise(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", x.alias("x")))


def _matrix(vectors: pd.Series) -> list[np.ndarray]:
    return [np.asarray(v, dtype=np.int64) for v in vectors]


def _positives(k: int) -> Callable:
    def run(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            av, rv = _matrix(anchors["ax"]), _matrix(rows["x"])
            width = max(map(len, av + rv))
            lists = Lists(rows["vec_id"].to_numpy(), rv, width)
            number = rows["row"].to_numpy()[lists.rows]
            for row, v in zip(anchors["anchor"], av):
                best, scores, _ = lists.search(np.pad(v, (0, width - len(v))), number != row, [(-math.inf, math.inf)], k)
                out += [(row, int(lists.ids[i]), max(LEAST, min(MOST, int(scores[i])))) for i in best[0]]
        return pd.DataFrame(out, columns=["anchor", "positive_id", "positive_score"])
    return run


def _negatives(k: int, window: tuple[int, int]) -> Callable:
    def run(key: tuple, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            av, rv = _matrix(anchors["ax"]), _matrix(rows["x"])
            width = max(map(len, av + rv))
            lists = Lists(rows["vec_id"].to_numpy(), rv, width)
            labels = rows["label"].to_numpy()[lists.rows]
            for row, label, v, positives in zip(anchors["anchor"], anchors["own"], av, anchors["scores"]):
                wanted = sorted({int(s) for s in positives})
                windows = [(s, *window_of(s, window)) for s in wanted]
                windows = [w for w in windows if w[1] <= w[2]]      # a negative positive score leaves none
                if windows:
                    best, scores, _ = lists.search(np.pad(v, (0, width - len(v))), labels != label, [w[1:] for w in windows], k)
                    for (s, _, _), found in zip(windows, best):
                        out += [(row, s, int(lists.ids[i]), int(scores[i])) for i in found]
        return pd.DataFrame(out, columns=["anchor", "positive_score", "negative_id", "negative_score"])
    return run


def _first(rows: DataFrame, keys: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), vec_id)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _part(key: Column, parts: Column) -> Column:
    """0 to parts - 1, of the same type as the other side's sequence (a cogroup casts nothing)."""
    return F.pmod(key, parts).cast("int")


def _dealt(df: DataFrame, *keys: str):
    """Grouped by ``keys``, in the session's number of tasks: the work per byte is far too
    large for tasks that are merged by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def _blocks_of(limit: int):
    return F.ceil(F.count(F.lit(1)) / F.lit(limit)).cast("int")


def mine_hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                        window: tuple[int, int] = WINDOW, block: int = BLOCK, group: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows (row, vec_id, label, x)`` as :func:`usable_rows` makes them, ``anchors`` some of
    them.  Vectors of different length are compared as if padded by zeros.  Rows that
    share a vec_id stay rows of their own: another row of the anchor's id may be its
    positive, and an anchor row that is repeated is mined as often.  Scores are exact
    integers; one beyond 64 bits is given as the nearest LONG.  Empty tables give no rows.
    """
    # positives: an anchor meets the blocks of its own label
    of_label = rows.groupBy("label").agg(_blocks_of(block).alias("nb"))
    of_anchors = anchors.groupBy("label").agg(_blocks_of(group).alias("ng"))
    parts = of_anchors.join(of_label, "label")
    own = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("x").alias("ax"))
    left = own.join(parts, F.col("own") == F.col("label")).select(
        "anchor", "own", "ax", _part(F.xxhash64("anchor"), F.col("ng")).alias("ag"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("ab"))
    right = rows.join(parts, "label").select(
        "row", "vec_id", "x", "label", _part(F.xxhash64("row"), F.col("nb")).alias("b"), F.explode(F.sequence(F.lit(0), F.col("ng") - 1)).alias("g"))
    found = _dealt(left, "own", "ab", "ag").cogroup(_dealt(right, "label", "b", "g")).applyInPandas(
        _positives(positives), "anchor long, positive_id long, positive_score long")
    best = materialise(_first(found, ["anchor"], "positive_score", "positive_id", positives).select("anchor", "positive_id", "positive_score"))

    # negatives: an anchor meets all blocks, with its positives' windows
    n = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    m = anchors.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    nb, ng = max(1, -(-n // block)), max(1, -(-m // group))
    scores = best.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))    # k a row at most
    left = own.join(scores, "anchor").select(
        "anchor", "own", "ax", "scores", _part(F.xxhash64("anchor"), F.lit(ng)).alias("ag"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("ab"))
    right = rows.select(
        "vec_id", "label", "x", _part(F.xxhash64("row"), F.lit(nb)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(ng - 1))).alias("g"))
    found = _dealt(left, "ab", "ag").cogroup(_dealt(right, "b", "g")).applyInPandas(
        _negatives(negatives, window), "anchor long, positive_score long, negative_id long, negative_score long")
    ranked = _first(found, ["anchor", "positive_score"], "negative_score", "negative_id", negatives)
    return best.join(ranked, ["anchor", "positive_score"]).join(own.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame, every: int = 50, **parameters: object) -> DataFrame:
    """Hard negatives of the rows whose ``vec_id`` is divisible by ``every``.

    ``embeddings (vec_id, embedding, label)``; rows with a NULL id, label or vector or a
    NULL, NaN or infinite component take no part; other columns are ignored.  Labels
    of ids divisible by 7 become ``(label + 1) % 10`` first, as the contract of the query
    lays down.  The result is that of :func:`mine_hard_negatives`.
    """
    rows = usable_rows(embeddings).withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine_hard_negatives(rows, rows.where(F.col("vec_id") % every == 0), **parameters)
