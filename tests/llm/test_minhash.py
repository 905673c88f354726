import random

import numpy as np

from setgraph.llm.common import shingles
from setgraph.llm.components import components
from setgraph.llm.minhash import COORDS, drop_near_duplicates, near_duplicates, sketch

from .conftest import plain, prose


def word_sets(text):
    ws = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "")).split(" ") if w]
    ws = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in ws]
    if 0 < len(ws) < 5:
        return {tuple(ws)}
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def brute(docs):
    sets = {i: word_sets(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def changed(r, text, edits):
    ws = text.split(" ")
    for _ in range(edits):
        ws[r.randrange(len(ws))] = f"w{r.randrange(10 ** 6)}"
    return " ".join(ws)


def test_large_groups_against_brute_force(spark, seed=1):
    """Copies with unrelated edits, copies of copies (chains) and cut copies."""
    r = random.Random(seed)
    docs, base = {}, prose(seed, 120)
    chain = base
    for i in range(40):
        docs[len(docs)] = changed(r, base, r.randrange(0, 9))
        chain = changed(r, chain, 2)
        docs[len(docs)] = chain
        words = base.split(" ")
        docs[len(docs)] = " ".join(words[:r.randrange(60, 120)])
        docs[len(docs)] = prose(1000 * seed + i + 1, r.randrange(1, 30))
    ids = list(docs)
    r.shuffle(ids)
    docs = {ids[i]: t for i, t in docs.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = sorted(tuple(x) for x in near_duplicates(df).collect())
    assert got == brute(docs)
    assert any(not x[3] for x in got)


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 5000):
        s = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        assert (sketch(s) < np.uint64(2 ** 63)).all() and len(sketch(s)) == COORDS
    errors = []
    for _ in range(60):
        both, a, b = (rng.integers(0, 2 ** 63, k).astype(np.uint64) for k in (300, 50, 50))
        errors.append((sketch(np.concatenate([both, a])) == sketch(np.concatenate([both, b]))).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_rounds_are_those_of_single_steps(monkeypatch):
    """Rounds taken at once give what they give one by one."""
    s = np.unique(np.random.default_rng(3).integers(0, 2 ** 63, 30).astype(np.uint64))
    at_once = sketch(s)
    monkeypatch.setattr(np, "log", lambda x: 0.0)
    assert (sketch(s) == at_once).all()


def test_components_of_chains_and_stars(spark):
    import hashlib
    key = lambda i: hashlib.md5(str(i).encode()).digest()
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    df = spark.createDataFrame([(bytearray(key(a)), bytearray(key(b))) for a, b in links], "a binary, b binary")
    root = {bytes(r["node"]): bytes(r["root"]) for r in components(df).collect()}
    assert len({root[key(i)] for i in range(61)}) == 1 and len({root[key(i)] for i in range(100, 140)}) == 1
    assert root[key(0)] != root[key(100)] and key(200) not in root
    assert components(df.limit(0)).count() == 0


def test_odd_rows(spark, odd, none):
    got = plain(near_duplicates(odd))
    assert len(got) == odd.count()
    by = {x[0]: x for x in got if x[0] is not None}
    assert by[1][2] == by[2][2] == 1 and by[1][3] and not by[2][3]
    assert [x for x in got if x[0] == 2] == [by[2]] * 2
    for i in (3, 4, 5):
        assert by[i] == (i, 0, i, True)
    assert by[8][2:] == (8, True) and by[9][2:] == (8, False)  # only A-Z are lower-cased, and they are
    assert [x for x in got if x[0] is None] == [(None, 0, None, True), (None, 56, None, True)]
    kept = drop_near_duplicates(odd)
    assert kept.schema == odd.schema
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(
        i for i, x in by.items() if x[3])
    assert near_duplicates(none).count() == 0 and drop_near_duplicates(none).count() == 0


def test_shingles_of_short_texts():
    assert len(shingles(None)) == len(shingles("")) == len(shingles(" \x0b\t")) == 0
    assert len(shingles("a b")) == 1 and (shingles("A b") == shingles("a\x0cb")).all() and (shingles("a b") != shingles("b a")).all()
    assert len(shingles("a b c d e a b c d e")) == 5 and len(shingles("a b c d e f")) == 1


def test_stage_keeps_rows_with_map_columns(spark):
    t = prose(1, 40)
    df = spark.createDataFrame([(1, t, {"a": 1}), (1, t, {"a": 2}), (2, t, {}), (3, prose(2, 40), None)], "doc_id long, text string, m map<string,int>")
    got = drop_near_duplicates(df)
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3] and got.columns == df.columns
