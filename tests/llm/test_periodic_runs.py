"""Periodic runs against a brute-force search, the transform against plain sums, odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from setgraph.llm import periodic_runs as pr

from .conftest import SF


def brute(words):
    """All runs by comparing the words at every distance."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def patchwork(r):
    words = []
    while len(words) < r.randrange(400):
        k, letters = r.choice([1, 1, 2, 3, 5, 8, 9, 15, 16, 17, 30, 60]), r.choice([1, 2, 3, 50])
        unit = [b"%d" % r.randrange(letters) for _ in range(k)] * r.randrange(1, 40 // k + 6)
        words += unit[:len(unit) - r.randrange(k + 1)] + [b"%d" % r.randrange(60) for _ in range(r.randrange(10))]
    return words


@pytest.mark.parametrize("seed", range(5))
def test_runs_are_those_of_brute_force(seed):
    r = random.Random(seed)
    for _ in range(80):
        texts = [patchwork(r) for _ in range(r.randrange(1, 5))]
        assert pr.runs_of_texts(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("length", [8, 16, 64])
def test_occurrences_are_those_of_plain_sums(length):
    r = np.random.default_rng(length)
    words = r.integers(1, 3, size=900)
    words[400:700] = np.tile(words[400:400 + length + 3], 300)[:300]
    first, last = (1 if length == 8 else length), 2 * length - 1
    blocks = np.arange(0, 900 - last - length + 1, length)
    want = {(b, d) for b in blocks for d in range(first, last + 1) if (words[b:b + length] == words[b + d:b + d + length]).all()}
    assert set(zip(*(x.tolist() for x in pr.occurrences(words, blocks, length, first, last)))) == want


def test_transform_multiplies():
    r = np.random.default_rng(1)
    a, b = r.integers(0, pr.PRIME, size=(2, 4, 32))
    got = pr.inverse_transform(pr.transform(a) * pr.transform(b) % pr.PRIME)
    for k in range(4):
        want = [sum(int(a[k, i]) * int(b[k, (j - i) % 32]) for i in range(32)) % pr.PRIME for j in range(32)]
        assert got[k].tolist() == want


def test_a_run_of_many_equal_words_and_a_long_text():
    assert pr.find_runs(np.ones(50_000, dtype=np.int64)) == [(0, 50_000, 1)]
    assert pr.find_runs(np.tile(np.arange(1, 7001), 20)) == [(0, 140_000, 7000)]
    assert pr.find_runs(np.random.default_rng(2).integers(1, 30, size=200_000)) == []


def by_contract(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words) if n < 3000 else pr.runs_of_texts([words])[0]
    best = max(runs, key=lambda x: (Fraction(x[1] - x[0], x[2]), -x[0], -x[2]), default=None)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    one = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *one, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), n)


def test_query_is_that_of_brute_force(spark):
    from setgraph.llm import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [by_contract(*d) for d in docs]
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and any(r[1] for r in want)


def test_ties_and_exact_exponents():
    assert pr.best_run([(0, 30, 2), (40, 70, 2), (80, 95, 1)]) == (0, 30, 2)
    assert pr.best_run([(0, 31, 3), (50, 81, 3), (60, 92, 3)]) == (60, 92, 3)
    assert pr.best_run([]) is None


def test_odd_rows_and_empty_table(spark, odd, none):
    got = pr.periodic_runs(odd.withColumn("n_runs", odd.line_no), planted=True).collect()
    assert len(got) == odd.count() and pr.periodic_runs(none).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    row = next(r for r in got if r["doc_id"] == 3)
    assert tuple(row) == (3, 0, None, None, None, None, empty, empty, 0)
