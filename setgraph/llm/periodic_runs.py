"""Periodic runs of words by block convolution at dyadic scales.

A run is a maximal stretch of words with smallest period q that holds at least
``REPEATS`` periods and ``LEAST`` words.  All texts of an Arrow batch stand in one
array of word numbers, a word of one text never equal to one of another, so no
match crosses texts.

At scale L (8, 16, 32, ...) the array is cut into aligned blocks of L words.  A run
of a period q from L to 2 L - 1 (at the least scale, from 1) holds a whole block and
that block's copy q words later.  The sum of squared differences of a block and
every window at a distance of that range is

    sum x^2 + sum y^2 - 2 sum x y,

its last part an exact number-theoretic transform modulo a prime.  Where the words
agree the sum is zero, so no occurrence is missed; a sum that is zero modulo the
prime alone is found out by the comparison of words from which every distance is
extended to its maximal stretch.  A stretch that several distances share has the
least of them as its period (the others are its multiples).

Two tests spare transforms and lose nothing: a block can only recur where each
eight of its words do, at a distance of the scale's range; and a block whose whole reach
lies in a known run of a period up to L gives only multiples of that period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import finish, map_arrow

LEAST = 24         # least words of a run
REPEATS = 3        # least periods of a run
BASE = 8           # words of a block at the least scale: LEAST words hold a block and its copy up to BASE words on
BATCH = 1 << 20    # numbers in one transform's table

# A prime 119 * 2^23 + 1 and a generator of its multiplicative group.
PRIME = 998244353
GENERATOR = 3

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _root_powers(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 to half - 1 of a primitive (2 half)-th root of one."""
    if (half, inverse) not in _roots:
        w = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        w = pow(w, PRIME - 2, PRIME) if inverse else w
        powers = np.ones(1, dtype=np.int64)
        while len(powers) < half:
            powers = np.concatenate([powers, powers * pow(w, len(powers), PRIME) % PRIME])
        _roots[half, inverse] = powers
    return _roots[half, inverse]


def transform(x: np.ndarray) -> np.ndarray:
    """Transforms of the rows of ``x`` (a power of two long), in bit-reversed order."""
    m, size = x.shape
    half = size // 2
    while half:
        parts = x.reshape(m, -1, 2, half)
        u, v = parts[:, :, 0], parts[:, :, 1]
        x = np.stack([(u + v) % PRIME, (u - v + PRIME) * _root_powers(half, False) % PRIME], axis=2).reshape(m, size)
        half //= 2
    return x


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are the rows of ``x``."""
    m, size = x.shape
    half = 1
    while half < size:
        parts = x.reshape(m, -1, 2, half)
        u, v = parts[:, :, 0], parts[:, :, 1] * _root_powers(half, True) % PRIME
        x = np.stack([(u + v) % PRIME, (u - v + PRIME) % PRIME], axis=2).reshape(m, size)
        half *= 2
    return x * pow(size, PRIME - 2, PRIME) % PRIME


def occurrences(words: np.ndarray, blocks: np.ndarray, length: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block start, distance)`` of every distance from ``first`` to ``last`` at which the
    ``length`` words from a start recur, up to accidental zeros modulo the prime.

    ``words`` are numbers below the prime; starts are such that all windows lie in it.
    """
    count = last - first + 1
    size = 1 << (length + count - 2).bit_length()
    starts, distances = [], []
    for lo in range(0, len(blocks), max(1, BATCH // size)):
        at = blocks[lo:lo + max(1, BATCH // size)]
        x = words[at[:, None] + np.arange(length)]
        y = words[at[:, None] + np.arange(first, last + length)]
        turned = np.zeros((len(at), size), dtype=np.int64)      # x backwards, so that the product correlates
        turned[:, 0] = x[:, 0]
        turned[:, size - length + 1:] = x[:, :0:-1]
        window = np.zeros((len(at), size), dtype=np.int64)
        window[:, :y.shape[1]] = y
        cross = inverse_transform(transform(turned) * transform(window) % PRIME)[:, :count]
        squares = np.concatenate([np.zeros((len(at), 1), dtype=np.int64), np.cumsum(y * y % PRIME, axis=1)], axis=1)
        own = (x * x % PRIME).sum(axis=1, keepdims=True)
        differences = (own + squares[:, length:length + count] - squares[:, :count] - 2 * cross) % PRIME
        i, d = np.nonzero(differences == 0)
        starts.append(at[i])
        distances.append(d + first)
    return (np.concatenate(starts), np.concatenate(distances)) if starts else (np.empty(0, dtype=np.int64),) * 2


def grams(words: np.ndarray) -> np.ndarray:
    """A number for the ``BASE`` words from each place (none for the last ``BASE`` - 1 places):
    equal wherever the words are, by a hash."""
    h, width = words.astype(np.uint64), 1
    while width < BASE:
        h = finish(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2
    return np.unique(h, return_inverse=True)[1].astype(np.int64)


def _recurs(keys: np.ndarray, grams: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Whether the gram at each place stands again at a distance from ``first`` to ``last``;
    ``keys`` are the grams with their places, sorted."""
    n = len(grams)
    base = grams[at] * (n + 1)
    found = np.searchsorted(keys, base + np.minimum(at + first, n))
    return (found < n) & (keys[np.minimum(found, n - 1)] <= base + np.minimum(at + last, n))


def _inside(runs: list[tuple[int, int, int]], most: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether each stretch lo to hi lies in one of the runs of a period up to ``most``."""
    known = sorted((s, e) for s, e, q in runs if q <= most)
    if not known:
        return np.zeros(len(lo), dtype=bool)
    starts = np.array([s for s, _ in known])
    ends = np.maximum.accumulate([e for _, e in known])
    i = np.searchsorted(starts, lo, side="right") - 1
    return (i >= 0) & (ends[np.maximum(i, 0)] >= hi)


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two arrays, read in growing pieces."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        to = min(n, at + step)
        differ = np.flatnonzero(a[at:to] != b[at:to])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def _extend(words: np.ndarray, start: int, length: int, d: int) -> tuple[int, int] | None:
    """The maximal stretch of period ``d`` around a block that recurs at ``d``; None if it
    does not."""
    right = start + _agree(words[start:], words[start + d:])
    if right < start + length:
        return None
    left = start - _agree(words[:start][::-1], words[:start + d][::-1])
    return left, right + d


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of an array of word numbers, by start and period."""
    n = len(words)
    if n < LEAST:
        return []
    gram = grams(words)
    keys = np.sort(gram * (len(gram) + 1) + np.arange(len(gram)))      # by gram, then place
    length, first, found = BASE, 1, {}
    while REPEATS * first <= n:
        last = 2 * length - 1
        # past the end stand words of no text, each of its own
        padded = np.concatenate([words, words.max() + 1 + np.arange(last + length)])
        blocks = np.arange(0, n - length + 1, length)
        runs = [(s, e, q) for (s, e), q in found.items()]
        blocks = blocks[~_inside(runs, length, blocks, blocks + last + length)]
        for j in range(0, length, BASE):
            if not len(blocks):
                break
            blocks = blocks[_recurs(keys, gram, blocks + j, first, last)]
        starts, distances = occurrences(padded, blocks, length, first, last)
        keep = ~_inside(runs, length, starts, starts + distances + length)
        starts, distances = starts[keep], distances[keep]
        done: dict[int, int] = {}       # distance -> the end of its last stretch, less the distance
        for i in np.lexsort((starts, distances)):
            start, d = int(starts[i]), int(distances[i])
            if start + length <= done.get(d, -1):
                continue
            stretch = _extend(words, start, length, d)
            if stretch is not None:
                done[d] = stretch[1] - d
                if stretch[1] - stretch[0] >= max(LEAST, REPEATS * d):
                    found[stretch] = min(d, found.get(stretch, d))
        first = length = 2 * length
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length/period, compared exactly; then least start, then period."""
    best = None
    for s, e, q in runs:
        if best is None or (e - s) * best[2] > (best[1] - best[0]) * q:
            best = (s, e, q)
    return best


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """All words of the texts as numbers from 1; equal exactly where text and word are."""
    parts, free = [], 1
    for words in texts:
        ids: defaultdict[bytes, int] = defaultdict(count(free).__next__)
        parts.append(np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words)))
        free += len(ids)
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, as ``(start, end, period)`` in its own word numbers."""
    ends = np.cumsum([0, *map(len, texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, q in find_runs(numbered(texts)):
        k = int(np.searchsorted(ends, s, side="right")) - 1
        out[k].append((s - int(ends[k]), e - int(ends[k]), q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that some run holds after its first period."""
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for s, e, q in runs:
            keep[s + q:e] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def repeat_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the repetition that the contract of the query plants by the id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long")


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words``.

    Words are runs without ASCII white space.  The run described is that of the greatest
    length/period (NULLs without a run); ``runs_sha256`` is of every run's
    ``start,length,period`` line, ``collapsed_sha256`` of the words that are left when
    each run keeps its first period.  A NULL or empty text has no words and no runs.
    Every row gives a row, repeated ones too; other columns are ignored.  With
    ``planted`` the words first repeat as the contract of the query lays down; a NULL
    doc_id plants nothing.  A task holds one batch of texts (one text at least) and
    numbers proportional to its words.
    """

    def run(batch: pa.RecordBatch) -> dict:
        ids = batch.column(0).to_pylist()
        words = [(t or b"").split() for t in batch.column(1).to_pylist()]
        if planted:
            words = [repeat_words(w, i) for w, i in zip(words, ids)]
        rows = []
        for i, w, runs in zip(ids, words, runs_of_texts(words)):
            s, e, q = best_run(runs) or (None, None, None)
            listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
            rows.append((i, len(runs), s, e - s if runs else None, q, 1000 * (e - s) // q if runs else None,
                         hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapse(w, runs)).hexdigest(), len(w)))
        fields = [f.split() for f in SCHEMA.split(", ")]
        return {name: pa.array(values, pa.string() if kind == "string" else pa.int64()) for (name, kind), values in zip(fields, zip(*rows))}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(rows, run, SCHEMA)
