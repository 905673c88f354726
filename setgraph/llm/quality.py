"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at one measure of a text and votes good, bad or abstains.  The
votes' joint counts over all documents are sufficient statistics: there are at
most 3^rules vote patterns, whatever the number of documents.
Expectation-maximisation on them estimates without labels, for each rule, the
chances of its votes on good and on bad texts (its accuracy and how often it
abstains), and the share of good texts.  A document's posterior probability of being good follows from its
pattern; documents below ``MIN_POSTERIOR`` are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _FACTORS, WordHashes, finish, map_arrow, materialise, texts

MIN_POSTERIOR = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_ROUNDS = 200
TOLERANCE = 1e-9

# The white space between words, and the symbols counted.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

_hashes = WordHashes()


@dataclass(frozen=True)
class Rule:
    """Votes bad outside [least, most], good inside [good_from, good_to] (nowhere
    unless given), else abstains.  That a defect is missing is no evidence of
    quality, so rules on defects do not vote good."""

    measure: str
    least: float = -np.inf
    most: float = np.inf
    good_from: float = np.inf
    good_to: float = -np.inf


RULES = (
    Rule("symbols_per_word", most=0.1),
    Rule("symbol_char_share", most=0.03),
    Rule("repeated_word_share", most=0.3),
    Rule("duplicate_line_share", most=0.4),
    Rule("scaled_distinct_words", least=1.0),
    Rule("mean_word_chars", least=3.0, most=11.0),
    Rule("closed_line_share", least=0.25),
    Rule("digit_share", most=0.2),
    Rule("prose_line_share", good_from=0.5, good_to=1.0),
    Rule("words", least=20, good_from=200, good_to=np.inf),
)


def measures(text: str | None) -> dict[str, float]:
    """The base counts and the rules' measures of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at just these six characters
    n = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = duplicates = closed = prose = 0
    for line in text.split("\n"):
        body = line.strip(WHITE)
        if body:
            lines += 1
            duplicates += line in seen
            seen.add(line)
            end = body[-1] in ".!?:;\"')…"
            closed += end
            prose += end and body[0].isalpha() and not any(c in body for c in SYMBOLS)
    repeated = 0
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=n)
    if n > 3:
        windows = finish(h[:-2] * _FACTORS[0] + h[1:-1] * _FACTORS[1] + h[2:] * _FACTORS[2])
        _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
        twice = count[which] > 1
        if twice.any():
            covered = np.zeros(n, dtype=bool)
            for k in range(3):
                covered[k:n - 2 + k] |= twice
            repeated = int(covered.sum())
    some = max(n, 1)
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": duplicates, "n_repeat_words": repeated,
            "symbols_per_word": symbols / some, "symbol_char_share": symbols / max(chars, 1),
            "repeated_word_share": repeated / some, "duplicate_line_share": duplicates / max(lines, 1),
            "scaled_distinct_words": len(set(words)) / some ** 0.75,  # distinct words grow slower than words
            "mean_word_chars": chars / some, "closed_line_share": (closed + 1) / (lines + 1),
            "prose_line_share": prose / max(lines, 1),
            "digit_share": sum(map(text.count, "0123456789")) / max(chars, 1), "words": n}


def votes(measured: dict[str, float]) -> list[int]:
    """1 good, 0 bad, -1 abstain, by rule."""
    out = []
    for r in RULES:
        x = measured[r.measure]
        out.append(0 if not r.least <= x <= r.most else 1 if r.good_from <= x <= r.good_to else -1)
    return out


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and by quality (0 bad, 1 good), rule and vote (abstain,
    bad, good) the chance of that vote."""

    prior: float
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) of vote patterns (rows), rules taken as independent given the quality."""
        log = np.log(self.chance)
        rules = np.arange(patterns.shape[1])
        bad, good = (log[y, rules, patterns + 1].sum(axis=1) for y in (0, 1))
        odds = np.log(self.prior) - np.log1p(-self.prior) + good - bad
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """By rule: the chance that a vote (not an abstention) is right."""
        share = np.array([1.0 - self.prior, self.prior])
        right = share[0] * self.chance[0, :, 1] + share[1] * self.chance[1, :, 2]
        return right / np.einsum("y,yrv->r", share, self.chance[:, :, 1:])


# Chances of (abstain, bad, good) on bad and on good texts before any data: a
# rule says the right thing on a third of the texts and seldom the wrong one.
_START = np.array([[0.65, 0.32, 0.03], [0.65, 0.03, 0.32]])
_START_PRIOR = 0.8


def fit(patterns: np.ndarray, counts: np.ndarray, strength: float = 20.0) -> LabelModel:
    """EM on vote patterns with their counts.

    Each rule's chances have a Dirichlet prior of ``strength`` votes around the
    start.  It keeps 'good' the side that good votes speak for and settles rules
    that hardly vote.
    """
    rules = patterns.shape[1]
    start = np.repeat(_START[:, None, :], rules, axis=1)
    model = LabelModel(_START_PRIOR, start)
    is_vote = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    for _ in range(MAX_ROUNDS):
        good = model.posterior(patterns) * counts
        weight = np.stack([counts - good, good])
        seen = np.einsum("yp,prv->yrv", weight, is_vote) + strength * start
        prior = (weight[1].sum() + _START_PRIOR * strength) / (counts.sum() + strength)
        new = LabelModel(float(prior), seen / seen.sum(axis=2, keepdims=True))
        moved = max(abs(new.prior - model.prior), np.abs(new.chance - model.chance).max())
        model = new
        if moved < TOLERANCE:
            break
    return model


def _measured(docs: DataFrame) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batch: pa.RecordBatch) -> dict:
        rows = [measures(t) for t in batch.column("text").to_pylist()]
        pattern = [sum((v + 1) * 3 ** j for j, v in enumerate(votes(r))) for r in rows]
        return {"doc_id": batch.column("doc_id"), **{k: pa.array([r[k] for r in rows], pa.int64()) for k in base},
                "pattern": pa.array(pattern, pa.int32())}

    return map_arrow(texts(docs), run, "doc_id long, " + ", ".join(f"{k} long" for k in base) + ", pattern int")


def decode(pattern: np.ndarray) -> np.ndarray:
    """Votes (columns) of pattern numbers."""
    return np.stack([pattern // 3 ** j % 3 - 1 for j in range(len(RULES))], axis=1)


def quality(docs: DataFrame, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, posterior`` per document.

    NULL and empty texts have no words and fail the base rule; repeated rows give
    equal rows and count as often as they stand; NULL ids are carried.  An empty
    table gives none.  Other columns are ignored.
    """
    rows = materialise(_measured(docs))
    table = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").toPandas()  # 3^rules rows at most
    patterns = decode(table["pattern"].to_numpy(dtype=np.int64))
    model = fit(patterns, table["n"].to_numpy(dtype=float)) if len(table) else None
    known = [(int(p), float(x)) for p, x in zip(table["pattern"], model.posterior(patterns))] if model else []
    chances = docs.sparkSession.createDataFrame(known, "of int, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.join(F.broadcast(chances), F.col("pattern") == F.col("of")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= min_posterior)).alias("kept"), "posterior")
