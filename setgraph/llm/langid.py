"""Language ID of code-switched text by a linear-chain conditional random field.

Each word of a text gets a language.  A word's score under a language is the sum
of weights of its hashed features (character 1- to 3-grams with word bounds,
prefixes and suffixes up to 4 characters, membership in each language's lexicon);
learned weights of language pairs score the step from word to word.  Forward-
backward gives every word's marginal probabilities; a text's language is the one
with the largest mean marginal, and that mean is its score.

Training maximises the conditional likelihood.  Texts carry one language label
each, so code-switched training sequences are put together from runs of words of
several texts; this is what the transitions are learned from.  The model is fitted
on a sample of the labelled rows, bounded by ``SAMPLE`` rows (``LEAST`` a language,
where there are so many that this is more) and ``RUNS`` runs of
words of each.  It knows every label; a language has ``BUCKETS`` weights, and all
lexicons together have ``LEXICON`` words.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, fresh, map_arrow, materialise, texts

SAMPLE = 3_000       # labelled rows that the model is fitted on, in even parts for the languages
LEAST = 30           # rows of a language's part at least
RUNS = 12            # runs of words taken from each of them, at most
RUN_WORDS = (4, 16)  # words of a run
LEXICON = 20_000     # words in all lexicons together, at most
BUCKETS = 1 << 16    # hashed features
EPOCHS = 4
SEQUENCE = 40        # words of a training sequence
STAY = 0.8           # chance that the next run of a training sequence keeps its language
SEED = 20240501
PIECE = 1 << 20      # characters of texts that are labelled at once, if not one text has more
UNKNOWN = "und"
MIN_SCORE = 0.5      # least mean confidence in a document's words with which the pipeline keeps it

_WORD = re.compile(r"[^\W\d_]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _bucket(parts: list[np.ndarray], kind: int) -> np.ndarray:
    """Hashed feature numbers of aligned code points; 0 is kept free."""
    h = np.full(len(parts[0]), kind, dtype=np.uint64)
    for p in parts:
        h = (h + p + np.uint64(1)) * _MUL
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def features(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, first place of each word's features) of words."""
    joined = "".join(f"^{w}$" for w in vocabulary)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, vocabulary), dtype=np.int64, count=len(vocabulary)) + 2
    end = np.cumsum(size)
    start, owner = end - size, np.repeat(np.arange(len(size)), size)
    ids, owners = [], []
    for n in (1, 2, 3):
        at = np.arange(len(c) - n + 1)
        at = at[owner[at] == owner[at + n - 1]]
        ids.append(_bucket([c[at + k] for k in range(n)], n))
        owners.append(owner[at])
    for n in (3, 4):  # affixes; shorter ones are n-grams with a word bound
        has = np.flatnonzero(size - 2 > n)
        ids += [_bucket([c[start[has] + 1 + k] for k in range(n)], 10 + n), _bucket([c[end[has] - 1 - n + k] for k in range(n)], 20 + n)]
        owners += [has, has]
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.searchsorted(owners[order], np.arange(len(size)))


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]      # word -> language
    weights: np.ndarray          # feature bucket x language
    lexical: np.ndarray          # language of the lexicon that has the word x language
    steps: np.ndarray            # language before x language

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        """Scores of words (rows) under the languages."""
        ids, starts = features(vocabulary)
        out = np.add.reduceat(self.weights[ids], starts, axis=0)
        known = np.fromiter((self.lexicon.get(w, -1) for w in vocabulary), dtype=np.int64, count=len(vocabulary))
        out[known >= 0] += self.lexical[known[known >= 0]]
        return out


def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Forward-backward over several sequences at once.

    ``scores`` holds the sequences' words one after the other.  All sequences go
    forward together, the longest first, so step t is one operation on those
    that have a t-th word."""
    n, k = scores.shape
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences longer than t
    first = np.concatenate([[0], np.cumsum(active)])
    begin = (np.cumsum(lengths) - lengths)[order]
    t_of = np.repeat(np.arange(longest), active)
    where = begin[np.arange(n) - first[t_of]] + t_of  # step-major place -> place in scores
    e = np.exp(scores - scores.max(axis=1, keepdims=True))[where]
    move = np.exp(steps)
    ahead = np.empty_like(e)
    for t in range(longest):
        at = slice(first[t], first[t + 1])
        a = e[at] if t == 0 else (ahead[first[t - 1]:first[t - 1] + active[t]] @ move) * e[at]
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    back = np.ones((int(active[0]) if longest else 0, k), dtype=e.dtype)
    out = np.empty_like(e)
    for t in range(longest - 1, -1, -1):
        at = slice(first[t], first[t + 1])
        if t + 1 < longest:
            after = slice(first[t + 1], first[t + 2])
            b = (e[after] * back[:active[t + 1]]) @ move.T
            back[:active[t + 1]] = b / b.sum(axis=1, keepdims=True)
        m = ahead[at] * back[:active[t]]
        out[at] = m / m.sum(axis=1, keepdims=True)
    result = np.empty_like(out)
    result[where] = out
    return result


def train(runs: list[tuple[int, list[str]]], languages: list[str], lexicon: dict[str, int], epochs: int = EPOCHS) -> Model:
    """Maximum conditional likelihood by AdaGrad on sequences of runs ``(language, words)``."""
    k, rng = len(languages), np.random.default_rng(SEED)
    model = Model(languages, lexicon, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32), np.zeros((k, k), np.float32))
    if k < 2 or not runs:
        return model
    vocabulary = sorted({w for _, run in runs for w in run})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids, starts = features(vocabulary)
    ends = np.append(starts[1:], len(ids))
    known = np.array([lexicon.get(w, -1) for w in vocabulary])
    coded = [(y, np.array([number[w] for w in run])) for y, run in runs]
    of = [[i for i, (y, _) in enumerate(coded) if y == lang] for lang in range(k)]
    of = [x for x in of if x]
    total = sum(len(r) for _, r in coded)
    seen = [np.full_like(a, 1e-6) for a in (model.weights, model.lexical, model.steps)]
    batch = 64
    for _ in range(epochs * max(1, total // (batch * SEQUENCE))):
        xs, ys = np.empty((batch, SEQUENCE), np.int64), np.empty((batch, SEQUENCE), np.int64)
        for b in range(batch):
            x, y, lang = [], [], int(rng.integers(len(of)))
            while sum(map(len, x)) < SEQUENCE:
                y_run, run = coded[of[lang][int(rng.integers(len(of[lang])))]]
                x.append(run)
                y.append(np.full(len(run), y_run))
                if rng.random() > STAY:
                    lang = int(rng.integers(len(of)))
            xs[b], ys[b] = np.concatenate(x)[:SEQUENCE], np.concatenate(y)[:SEQUENCE]
        uniq, inverse = np.unique(xs.ravel(), return_inverse=True)
        size = ends[uniq] - starts[uniq]
        # the features of the batch's words
        flat = np.repeat(starts[uniq] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own = ids[flat]
        scores = np.add.reduceat(model.weights[own], np.cumsum(size) - size, axis=0)
        lex = known[uniq]
        scores[lex >= 0] += model.lexical[lex[lex >= 0]]
        p, pairs = _expectations(scores[inverse].reshape(batch, SEQUENCE, k), model.steps)
        truth = np.eye(k, dtype=np.float32)[ys]
        residual = np.zeros((len(uniq), k), np.float32)
        np.add.at(residual, inverse, (truth - p).reshape(-1, k))
        g_steps = np.zeros((k, k), np.float32)
        np.add.at(g_steps, (ys[:, :-1].ravel(), ys[:, 1:].ravel()), 1.0)
        g_steps -= pairs
        per_feature = np.repeat(residual, size, axis=0)
        touched, place = np.unique(own, return_inverse=True)
        g_weights = np.stack([np.bincount(place, per_feature[:, j], len(touched)) for j in range(k)], axis=1).astype(np.float32)
        g_lex = np.zeros((k, k), np.float32)
        np.add.at(g_lex, lex[lex >= 0], residual[lex >= 0])
        for value, sums, rows, g in ((model.weights, seen[0], touched, g_weights), (model.lexical, seen[1], slice(None), g_lex),
                                     (model.steps, seen[2], slice(None), g_steps)):
            g = g / batch - 1e-4 * value[rows]
            sums[rows] += g * g
            value[rows] += 0.1 * g / np.sqrt(sums[rows])
    return model


def _expectations(scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals and expected counts of language pairs of equally long sequences."""
    b, t, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(steps)
    ahead, back = np.empty_like(e), np.ones_like(e)
    for i in range(t):
        a = e[:, i] if i == 0 else (ahead[:, i - 1] @ move) * e[:, i]
        ahead[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(t - 2, -1, -1):
        x = (e[:, i + 1] * back[:, i + 1]) @ move.T
        back[:, i] = x / x.sum(axis=1, keepdims=True)
    p = ahead * back
    p /= p.sum(axis=2, keepdims=True)
    # summed over the places by a product of matrices: memory does not grow with the pairs
    before, after = ahead[:, :-1].reshape(-1, k), (e[:, 1:] * back[:, 1:]).reshape(-1, k)
    total = ((before @ move) * after).sum(axis=1, keepdims=True)
    return p, move * ((before / total).T @ after)


def _sample(docs: DataFrame, rows: int) -> tuple[DataFrame, list[str]]:
    """``lang, text`` of the training texts, and the languages.  Each language gets an
    even part of ``rows``, but ``LEAST`` (all of its rows if it has fewer), picked by hashes."""
    known = docs.where((crc_mod("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language, like the model
    if not counts:
        return docs.limit(0).select(F.lit("").alias("lang"), F.lit("").alias("text")), []
    part = max(rows / len(counts), LEAST)
    shares = docs.sparkSession.createDataFrame([(r["lang"], part / r["n"]) for r in counts], "of string, share double")
    pick = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1_000_000)) / 1e6
    chosen = known.join(F.broadcast(shares), F.col("lang") == F.col("of")).where(pick < F.col("share")).select("id", "of")
    chosen = chosen.limit(int(2 * part * len(counts)))  # bounded: may be broadcast
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = d.join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("id")).select(F.col("of").alias("lang"), "text")
    return materialise(found), sorted(r["lang"] for r in counts)


def fit(docs: DataFrame, rows: int = SAMPLE) -> Model:
    """The model of the labelled rows whose crc32(doc_id) mod 5 is not 0."""
    data, languages = _sample(docs, rows)
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batch: pa.RecordBatch) -> dict:
        seen: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            seen.update((w, lang) for w in set(words(text)))
        return {"word": pa.array([w for w, _ in seen], pa.string()), "lang": pa.array([lang for _, lang in seen], pa.string()),
                "n": pa.array(list(seen.values()), pa.int64())}

    def cut(batch: pa.RecordBatch) -> dict:
        langs, out = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found = words(text)
            rng = np.random.default_rng([SEED, len(found)])
            for _ in range(min(RUNS, -(-len(found) // RUN_WORDS[1]))):
                size = int(rng.integers(RUN_WORDS[0], RUN_WORDS[1] + 1))
                at = int(rng.integers(max(1, len(found) - size + 1)))
                langs.append(lang)
                out.append(" ".join(found[at:at + size]))
        return {"lang": pa.array(langs, pa.string()), "run": pa.array(out, pa.string())}

    by_word = map_arrow(data, count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    best = by_word.groupBy("word").agg(F.sum("n").alias("all"), F.max(F.struct("n", "lang")).alias("top"))
    lexicon = best.where("all >= 3 AND top.n >= 0.9 * all").orderBy(F.desc("all"), "word").limit(LEXICON).select("word", "top.lang").collect()
    runs = map_arrow(data, cut, "lang string, run string").where("run != ''").collect()  # RUNS * 2 * rows short runs at most
    ordered = sorted((number[r["lang"]], r["run"]) for r in runs)
    return train([(y, run.split(" ")) for y, run in ordered], languages, {r["word"]: number[r["lang"]] for r in lexicon})


def _labelled(texts_: list[str | None], model: Model) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Words of each text, their numbers and their marginals, text after text."""
    found = [words(t) for t in texts_]
    number: dict[str, int] = {}
    coded = np.fromiter((number.setdefault(w, len(number)) for f in found for w in f), dtype=np.int64)
    lengths = np.array([len(f) for f in found], dtype=np.int64)
    if not len(coded) or not model.languages:
        return found, lengths, np.empty((len(coded), len(model.languages)), np.float32)
    return found, lengths, marginals(model.emissions(list(number))[coded], lengths, model.steps)


def _pieces(texts_: list[str | None]) -> list[list[str | None]]:
    """Runs of texts that have ``PIECE`` characters together, or single texts of more."""
    out, held = [], 0
    for text in texts_:
        size = len(text or "")
        if not out or held + size > PIECE:
            out.append([])
            held = 0
        out[-1].append(text)
        held += size
    return out


def _languages(texts_: list[str | None], model: Model) -> tuple[list[str], list[float], list[float]]:
    """Language and score of each text, the largest mean marginal of its words, and the
    mean of each word's largest marginal, which mixed languages do not lower.

    An Arrow batch may have 8 MB of text, of which the words, their features and marginals
    take many times as much: it is labelled piece by piece."""
    names, scores, sure = [], [], []
    for piece in _pieces(texts_):
        for whole, part in zip((names, scores, sure), _piece_languages(piece, model)):
            whole += part
    return names, scores, sure


def _piece_languages(texts_: list[str | None], model: Model) -> tuple[list[str], list[float], list[float]]:
    _, lengths, p = _labelled(texts_, model)
    names, scores, sure = [UNKNOWN] * len(texts_), [0.0] * len(texts_), [0.0] * len(texts_)
    ends = np.cumsum(lengths)
    for i, (text, a, b) in enumerate(zip(texts_, ends - lengths, ends)):
        if b > a and model.languages and any(map(str.isalpha, text)):
            mean = p[a:b].mean(axis=0)
            names[i], scores[i] = model.languages[int(mean.argmax())], float(min(mean.max(), 1.0))
            sure[i] = float(min(p[a:b].max(axis=1).mean(), 1.0))
    return names, scores, sure


def identify_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document.

    NULL texts and texts without a letter are ``und`` with score 0; so are all where
    there are no labelled rows.  Repeated rows give equal rows; a NULL id is
    carried, learned from never and not held out.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def run(batch: pa.RecordBatch) -> dict:
        names, values, _ = _languages(batch.column("text").to_pylist(), shared.value)
        return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(values, pa.float64())}

    rows = map_arrow(texts(docs), run, "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, word_no, word, lang, probability``: the language of every word."""
    if not model.languages:
        raise ValueError("the model knows no language")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        found, lengths, p = _labelled(batch.column("text").to_pylist(), shared.value)
        best = p.argmax(axis=1) if len(p) else np.empty(0, np.int64)
        return {"doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(lengths)), lengths))),
                "word_no": pa.array(np.concatenate([np.arange(n) for n in lengths] or [[]]).astype(np.int64)),
                "word": pa.array([w for f in found for w in f], pa.string()),
                "lang": pa.array([shared.value.languages[i] for i in best], pa.string()),
                "probability": pa.array(p[np.arange(len(p)), best].astype(np.float64))}

    return map_arrow(texts(docs), run, "doc_id long, word_no long, word string, lang string, probability double")


def keep_identified(docs: DataFrame, model: Model | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or whose words have, on the
    mean, a best language of a probability below ``min_score``.  Clean text of several
    languages stays."""
    plain = fresh(docs, "plain_text")
    shared, columns = docs.sparkSession.sparkContext.broadcast(model or fit(docs)), docs.columns

    def run(batch: pa.RecordBatch) -> dict:
        names, _, sure = _languages(batch.column(plain).to_pylist(), shared.value)
        keep = pa.array([n != UNKNOWN and x >= min_score for n, x in zip(names, sure)], pa.bool_())
        return {c: batch.column(c).filter(keep) for c in columns}

    return map_arrow(docs.withColumn(plain, F.col("text").cast("string")), run, docs.schema)
