"""Toxicity by maximum-scoring segments of token log-odds.

Scores.  A token's feature chain is its first 3, 4, 5 and 6 characters and the whole
word, so that inflected forms never seen share their stem's evidence.  For each
feature the share of toxic texts among the training texts that hold it is
estimated with a Beta (Dirichlet) prior centred on the estimate of the feature
before it in the chain, and on the overall share for the first.  The token's
score is the log-odds against the overall share, less a drift, bounded.

Segments.  One linear scan over every occurrence finds all maximal scoring segments
(those whose score no extension or part of them raises).  Within a segment a word
is evidence once, so that texts that say one word over and over do not pile it up:
a segment counts with its best part when repeats are words without evidence.  Under chance the best segment of a
text of n tokens follows an extreme-value law: it is beyond x with a probability
of 1 - exp(-K n e^(-lambda x)).  lambda and K are fitted to the best segments of
clean training texts.  A segment is significant where its expected number by
chance is small; a text's evidence is the sum of what its significant segments
have beyond chance, and a logistic law on it, fitted to the training texts, gives
the score.

The training texts are a sample, bounded by ``SAMPLE`` rows per label, of the
labelled rows outside the held-out third.  Counts of their features are taken by
distributed aggregation; the table that goes to the tasks holds the ``FEATURES``
strongest at most.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_arrow, materialise, texts

SAMPLE = 8_000        # training rows per label at most
FEATURES = 60_000     # features in the model at most
MIN_TEXTS = 3         # training texts that a feature must stand in
PRIOR_TEXTS = 8.0     # weight of the prior, in texts
DRIFT = 0.7           # taken from each token's log-odds, so that chance scores fall
BOUND = 6.0           # of a token's log-odds
STEMS = (3, 4, 5, 6)
PREDICT_FROM = 0.7

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def chain(word: str) -> list[str]:
    """The word's features, the most general first; stems end in ``*``."""
    return [f"{word[:k]}*" for k in STEMS if len(word) > k] + [word]


class Scores(dict):
    """word -> score, filled on demand from the feature table and emptied when large."""

    LIMIT = 200_000

    def __init__(self, log_odds: dict[str, float]):
        super().__init__()
        self.log_odds = log_odds

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        found = [x for f in chain(word) if (x := self.log_odds.get(f)) is not None]
        score = self[word] = min(max(found[-1] if found else 0.0, -BOUND), BOUND) - DRIFT
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order.

    One scan over the positive scores.  A candidate keeps the sum before it
    (``before``), up to its end (``upto``) and the nearest earlier candidate that
    begins lower (``link``); it swallows that one while its own end is higher.
    Following links makes the scan linear.
    """
    sums = np.cumsum(scores)
    out: list[tuple[int, int]] = []
    before: list[float] = []
    upto: list[float] = []
    link: list[int] = []
    for i in np.flatnonzero(scores > 0.0).tolist():
        start, high = i, float(sums[i])
        low = high - float(scores[i])
        j = len(out) - 1
        while True:
            while j >= 0 and before[j] >= low:
                j = link[j]
            if j < 0 or upto[j] >= high:
                break
            start, low, back = out[j][0], before[j], link[j]
            del out[j:], before[j:], upto[j:], link[j:]
            j = back
        out.append((start, i + 1))
        before.append(low)
        upto.append(high)
        link.append(j)
    return [(a, b, h - l) for (a, b), h, l in zip(out, upto, before)]


def token_scores(words: list[str], scores: Scores) -> np.ndarray:
    """The scores of a text's tokens, every occurrence alike."""
    return np.fromiter(map(scores.__getitem__, words), dtype=np.float64, count=len(words))


def once(words: list[str], values: np.ndarray) -> float:
    """The largest sum of consecutive tokens in which a word's positive score counts
    once and its repeats count as words without evidence.

    A binary tree over the positive tokens and the gaps before them keeps sums and best
    suffix sums up to the present token.  A word's earlier occurrence becomes a repeat
    when it comes again, so a token costs a few point updates: O(n log n) in all."""
    places = np.flatnonzero(values > 0.0)
    fall = np.concatenate([[0.0], np.cumsum(np.minimum(values, 0.0))])[places]
    gaps = np.diff(fall, prepend=fall[:1]).tolist()
    size = 1 << (2 * len(places)).bit_length()
    total, suffix = [0.0] * (2 * size), [0.0] * (2 * size)

    def put(leaf: int, x: float) -> None:
        i = size + leaf
        total[i], suffix[i] = x, max(x, 0.0)
        while i > 1:
            i >>= 1
            right = 2 * i + 1
            total[i] = total[right - 1] + total[right]
            suffix[i] = max(suffix[right], suffix[right - 1] + total[right])

    best, last = 0.0, {}
    for k, j in enumerate(places.tolist()):
        if words[j] in last:
            put(2 * last[words[j]] + 1, -DRIFT)
        last[words[j]] = k
        put(2 * k, gaps[k])
        put(2 * k + 1, float(values[j]))
        best = max(best, suffix[1])
    return best


def passages(words: list[str], values: np.ndarray) -> list[tuple[int, int, float]]:
    """The maximal scoring segments with what they count when a word is evidence once in each."""
    out = []
    for a, b, s in segments(values):
        positive = [w for w, x in zip(words[a:b], values[a:b]) if x > 0.0]
        out.append((a, b, s if len(set(positive)) == len(positive) else once(words[a:b], values[a:b])))
    return out


@dataclass(frozen=True)
class Model:
    """Feature log-odds, the extreme-value law's lambda and log K, the logistic law."""

    log_odds: dict[str, float]
    decay: float
    log_k: float
    weights: tuple[float, float]

    def significant(self, text: str | None, scores: Scores, most_by_chance: float = 0.05) -> tuple[list[tuple[int, int, float]], int]:
        """Significant segments as (first token, end, evidence) and the number of tokens."""
        words = tokens(text)
        values = token_scores(words, scores)
        base = self.log_k + np.log(max(len(words), 1))
        found = ((a, b, self.decay * s - base) for a, b, s in passages(words, values))
        return [(a, b, e) for a, b, e in found if e > -np.log(most_by_chance)], len(words)

    def score(self, evidence: float) -> float:
        a, b = self.weights
        return float(1.0 / (1.0 + np.exp(-(a + b * np.log1p(evidence)))))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``text, toxic, fold``: the training texts.  At most ``rows`` of each label, by
    the hash of their id, of rows whose crc32(doc_id) mod 3 is not 1; ids with
    several labels count as toxic if one says so, and equal texts once.  A quarter (fold 0) calibrates."""
    known = (labels.where(crc_mod("doc_id", 3) != 1).where(F.col("toxic").isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(rows) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # 2 * rows at most, so it may be broadcast
    d = texts(docs)
    return materialise(d.join(F.broadcast(chosen), d["doc_id"] == chosen["id"]).where(F.col("text").isNotNull())
                       .dropDuplicates(["text"]).select("text", "toxic", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(4)).cast("int").alias("fold")))


def _log_odds(train: DataFrame, features: int = FEATURES) -> dict[str, float]:
    def run(batch: pa.RecordBatch) -> dict:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update({f for w in set(tokens(text)) for f in chain(w)})
        names = list(counts[0].keys() | counts[1].keys())
        return {"feature": pa.array(names, pa.string()), "clean": pa.array([counts[0][f] for f in names], pa.int64()),
                "toxic": pa.array([counts[1][f] for f in names], pa.int64())}

    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    overall = (sizes.get(1, 0) + 1.0) / (sizes.get(0, 0) + sizes.get(1, 0) + 2.0)
    t, c = F.col("toxic") + F.lit(PRIOR_TEXTS * overall), F.col("clean") + F.lit(PRIOR_TEXTS * (1 - overall))
    far = F.abs(F.log(t / c) - F.lit(float(np.log(overall / (1 - overall))))) / F.sqrt(F.lit(1.0) / t + F.lit(1.0) / c)
    best = (map_arrow(train, run, "feature string, clean long, toxic long").groupBy("feature")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(F.col("clean") + F.col("toxic") >= MIN_TEXTS)
            .orderBy(far.desc(), "feature").limit(features).collect())
    table = {r["feature"]: (r["toxic"], r["clean"]) for r in best}
    shares: dict[str, float] = {}
    for f in sorted(table, key=lambda f: (len(f) if f[-1] == "*" else 10 ** 9, f)):  # stems by length, then words
        parents = chain(f[:-1] + "~" if f[-1] == "*" else f)[:-1]
        parent = next((shares[g] for g in reversed(parents) if g in shares and g != f), overall)
        n_toxic, n_clean = table[f]
        shares[f] = (n_toxic + PRIOR_TEXTS * parent) / (n_toxic + n_clean + PRIOR_TEXTS)
    logit = lambda p: float(np.log(p / (1 - p)))
    return {f: logit(p) - logit(overall) for f, p in shares.items()}


def _law(held: DataFrame, log_odds: dict[str, float]) -> tuple[float, float]:
    """lambda and log K from the clean calibration texts.

    lambda solves E[e^(lambda s)] = 1 over the tokens' scores; K makes the expected
    number of chance segments beyond their median equal to that seen.  Both need only counts
    of scores in steps of 0.05."""
    shared = held.sparkSession.sparkContext.broadcast(log_odds)

    def run(batch: pa.RecordBatch) -> dict:
        scores, single, best = Scores(shared.value), Counter(), Counter()
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            values = token_scores(words, scores)
            single.update(np.round(values * 20).astype(int).tolist())
            best.update(round(s * 20) for *_, s in passages(words, values))
        keys = [*((0, k) for k in single), *((1, k) for k in best)]
        return {"kind": pa.array([k for k, _ in keys], pa.int32()), "step": pa.array([k for _, k in keys], pa.int32()),
                "n": pa.array([(single, best)[kind][k] for kind, k in keys], pa.int64())}

    rows = (map_arrow(held.where("toxic = 0").select("text"), run, "kind int, step int, n long")
            .groupBy("kind", "step").agg(F.sum("n").alias("n")).toPandas())
    one, two = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
    # one toxic token at least, so that lambda exists also where no clean one is positive
    x = np.append(one["step"].to_numpy() / 20.0, BOUND - DRIFT)
    w = np.append(one["n"].to_numpy(dtype=float), 1.0)
    low, high = 0.01, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (w * (np.exp(mid * x) - 1.0)).sum() < 0 else (low, mid)
    decay = low
    if not len(two):
        return float(decay), float(-np.log(w.sum()))
    # matched at the median, which a few mislabelled texts do not move
    two = two.sort_values("step")
    count = two["n"].to_numpy(dtype=float)
    at = int(np.searchsorted(np.cumsum(count), count.sum() / 2))
    return float(decay), float(np.log(count[at:].sum()) + decay * two["step"].iloc[at] / 20.0 - np.log(w.sum()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weights of P(y = 1 | x) by Newton's method, slightly drawn towards (-2, 2)."""
    design, at = np.stack([np.ones_like(x), x], axis=1), np.array([-2.0, 2.0])
    prior = at.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -30, 30)))
        gradient = design.T @ (y - p) - 0.1 * (at - prior)
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), gradient)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(max(at[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, features: int = FEATURES) -> Model:
    """The model of the labelled rows outside the held-out third."""
    data = sample(docs, labels, rows)
    log_odds = _log_odds(data.where("fold != 0"), features)
    held = data.where("fold = 0")
    decay, log_k = _law(held, log_odds)
    raw = Model(log_odds, decay, log_k, (-2.0, 2.0))
    pairs = _evidence(held.select("text", "toxic"), raw, ["toxic"], "toxic int").select("toxic", "evidence").toPandas()
    weights = _logistic(np.log1p(pairs["evidence"].to_numpy()), pairs["toxic"].to_numpy(dtype=float)) if len(pairs) else (-2.0, 2.0)
    return Model(log_odds, decay, log_k, weights)


def _evidence(rows: DataFrame, model: Model, carry: list[str], schema: str) -> DataFrame:
    """``carry, n_passages, evidence, score`` per row; evidence is summed over the significant segments."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        m = shared.value
        if _scores.get("of") is not m.log_odds:  # one table per model and worker
            _scores.update({"of": m.log_odds, "scores": Scores(m.log_odds)})
        found = [m.significant(t, _scores["scores"])[0] for t in batch.column("text").to_pylist()]
        sums = [sum(e for *_, e in f) for f in found]
        return {**{c: batch.column(c) for c in carry}, "n_passages": pa.array([len(f) for f in found], pa.int64()),
                "evidence": pa.array(sums, pa.float64()), "score": pa.array([m.score(e) for e in sums], pa.float64())}

    return map_arrow(rows, run, f"{schema}, n_passages long, evidence double, score double")


_scores: dict = {}


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, first_token, end_token, evidence, passage``: the significant passages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        scores, rows = Scores(shared.value.log_odds), []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = shared.value.significant(text, scores)[0]
            places = [m.span() for m in _TOKEN.finditer(text.lower())] if found else []
            # lower-casing may change the length of a few letters; then the passage is cut from the lowered text
            body = text if found and len(text.lower()) == len(text) else (text or "").lower()
            rows += [(i, a, b, e, body[places[a][0]:places[b - 1][1]]) for a, b, e in found]
        at = pa.array([r[0] for r in rows], pa.int64())
        return {"doc_id": batch.column("doc_id").take(at), "first_token": pa.array([r[1] for r in rows], pa.int64()),
                "end_token": pa.array([r[2] for r in rows], pa.int64()), "evidence": pa.array([r[3] for r in rows], pa.float64()),
                "passage": pa.array([r[4] for r in rows], pa.string())}

    return map_arrow(texts(docs), run, "doc_id long, first_token long, end_token long, evidence double, passage string")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` per document.

    NULL and empty texts have no passages and the score of none.  Without labelled
    rows no token is evidence.  Repeated rows give equal rows; a NULL id is
    carried and not held out.  Other columns are ignored.
    """
    model = fit(docs, labels)
    rows = _evidence(texts(docs), model, ["doc_id"], "doc_id long")
    return rows.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                       F.when(F.col("score") >= PREDICT_FROM, 1).otherwise(0).alias("predicted"), "n_passages")
