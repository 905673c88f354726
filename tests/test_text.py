import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from setgraph.functions import tokenize
from setgraph.operators import text
from setgraph.operators import (cooccurrence, cooccurrence_stripes, flatten_stripes, merge_stripes, stripes_from_pairs,
                                terms, word_count)

from .brute import lines, tokenize as py_tokenize
from .conftest import rows

CORPUS = ["A b, a", "b", "", "x-y_z's 3%"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(c,) for c in CORPUS], "text string")


def test_tokenize_fixture(spark, corpus):
    got = [r[0] for r in corpus.select(tokenize("text")).collect()]
    assert got == [["a", "b", "a"], ["b"], [], ["x", "y", "z", "s", "3%"]]


def test_tokenize_keeps_non_delimiters(spark):
    df = spark.createDataFrame([("@a%b+c=d|e^f`g *$&#/\t\f\"'\\,.:;?![](){}<>~-_ H9",)], "text string")
    assert df.select(tokenize("text")).first()[0] == ["@a%b+c=d|e^f`g", "h9"]


def test_word_count_fixture(spark, corpus):
    assert rows(word_count(corpus)) == sorted(
        [("a", 2), ("b", 2), ("x", 1), ("y", 1), ("z", 1), ("s", 1), ("3%", 1)])


def test_cooccurrence_fixture(spark, corpus):
    expected = sorted([("a", "b", 1), ("a", "a", 1), ("b", "a", 1), ("x", "y", 1), ("x", "z", 1),
                       ("x", "s", 1), ("x", "3%", 1), ("y", "z", 1), ("y", "s", 1), ("y", "3%", 1),
                       ("z", "s", 1), ("z", "3%", 1), ("s", "3%", 1)])
    assert rows(cooccurrence(corpus)) == expected


def test_stripes_fixture(spark, corpus):
    got = {r["term1"]: dict(r["stripe"]) for r in cooccurrence_stripes(corpus).collect()}
    assert got == {"a": {"a": 1, "b": 1}, "b": {"a": 1}, "x": {"y": 1, "z": 1, "s": 1, "3%": 1},
                   "y": {"z": 1, "s": 1, "3%": 1}, "z": {"s": 1, "3%": 1}, "s": {"3%": 1}}
    # second terms are stored in byte order
    keys = cooccurrence_stripes(corpus).where("term1 = 'x'").select(F.map_keys("stripe")).first()[0]
    assert keys == sorted(keys) == ["3%", "s", "y", "z"]


def _py_pairs(texts, context="line"):
    out = {}
    for text in texts:
        ctxs = lines(text) if context == "line" else [text]
        for c in ctxs:
            ts = py_tokenize(c)
            for i in range(len(ts)):
                for j in range(i + 1, len(ts)):
                    out[(ts[i], ts[j])] = out.get((ts[i], ts[j]), 0) + 1
    return sorted((a, b, n) for (a, b), n in out.items())


def test_cooccurrence_chunks_and_repeats(spark):
    # long line (several chunks), repeated lines, multi-line text
    long_line = " ".join(f"w{i % 7}" for i in range(40))
    texts = [long_line, long_line, "p q\nq p\r\nr", "p q"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = _py_pairs(texts)
    for chunk in (1, 3, 256):
        for encode in (False, True):
            assert rows(cooccurrence(df, chunk=chunk, encode=encode)) == expected
    assert rows(cooccurrence(df, context="row")) == _py_pairs(texts, "row")


def test_stripes_flatten_equal_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    pairs = rows(cooccurrence(df, encode=False))
    assert rows(cooccurrence(df, encode=True)) == pairs
    assert rows(flatten_stripes(cooccurrence_stripes(df, encode=True))) == pairs


def test_terms_positions(spark):
    df = spark.createDataFrame([(7, "A b\n\nc-d"), (8, None)], "id long, text string")
    assert rows(terms(df, "text", keys=["id"])) == [
        (7, 0, 0, "a"), (7, 0, 1, "b"), (7, 2, 0, "c"), (7, 2, 1, "d")]


def test_word_count_matches_python_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = {}
    for (text,) in df.select("text").collect():
        for t in py_tokenize(text):
            expected[t] = expected.get(t, 0) + 1
    got = dict(rows(word_count(df)))
    assert got == expected
    assert word_count(df).schema.simpleString() == "struct<term:string,n:bigint>"


def test_word_count_ignores_null(spark):
    df = spark.createDataFrame([(None,), ("a a",)], "text string")
    assert rows(word_count(df)) == [("a", 2)]
    assert rows(cooccurrence(df.where(F.lit(True)))) == [("a", "a", 1)]


def test_tokenizer_matches_python_on_random_text(spark):
    import random
    rnd = random.Random(7)
    alphabet = list(" *$&#/\t\n\f\"'\\,.:;?![](){}<>~-_\r") + list("aZ9@%+=|^`é") + ["ß", "Ab"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 30))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = dict(rows(df.select("id", tokenize("text").alias("t"))))
    for i, t in enumerate(texts):
        assert got[i] == py_tokenize(t), repr(t)


def test_long_context_ships_suffixes(spark):
    from setgraph.operators.text import _chunks
    df = spark.createDataFrame([(list(map(str, range(5000))), 1), (["a", "b"], 2)], "terms array<string>, w long")
    sizes = sorted(r[0] for r in _chunks(df, 1024).select(F.size("rest")).collect())
    assert sizes == [2, 5000 - 4 * 1024, 5000 - 3 * 1024, 5000 - 2 * 1024, 5000 - 1024, 5000]
    assert sum(sizes) < 5000 * 5000 / 1024


def test_stripe_rows_are_bounded(spark):
    df = spark.createDataFrame([(" ".join(["x", *(f"w{i:03d}" for i in range(50))]),)], "text string")
    rows_ = cooccurrence_stripes(df, row_limit=7).select("term1", "part", F.map_keys("stripe").alias("keys")).collect()
    assert all(0 < len(r["keys"]) <= 7 for r in rows_)
    own = sorted((r["part"], r["keys"]) for r in rows_ if r["term1"] == "x")
    assert [p for p, _ in own] == list(range(len(own))) and [t for _, ts in own for t in ts] == [f"w{i:03d}" for i in range(50)]
    assert rows(flatten_stripes(cooccurrence_stripes(df, row_limit=7))) == rows(cooccurrence(df))


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_merged_stripes_are_those_of_the_whole(spark, limit):
    r = random.Random(limit)
    texts = [" ".join(r.choice("a b c d e f g h i j k l".split()) for _ in range(r.randrange(9))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id long, text string")
    halves = [cooccurrence_stripes(df.where(c), row_limit=limit).checkpoint() for c in (F.col("id") < 13, F.col("id") >= 13)]
    got = merge_stripes(*halves, row_limit=limit).checkpoint()
    assert rows(flatten_stripes(got), "term1", "term2", "n") == rows(flatten_stripes(cooccurrence_stripes(df)), "term1", "term2", "n")
    by = {}
    for x in sorted(got.select("term1", "part", F.map_keys("stripe").alias("keys")).collect(), key=lambda x: (x["term1"], x["part"])):
        by.setdefault(x["term1"], []).append(x["keys"])
        assert x["part"] == len(by[x["term1"]]) - 1
    for parts in by.values():       # all rows but the last are full, and keys ascend over the rows
        assert all(len(p) == limit for p in parts[:-1]) and 1 <= len(parts[-1]) <= limit
        assert sum(parts, []) == sorted(sum(parts, []))
    # merged stripes can be merged again, also with none
    none = got.limit(0)
    assert rows(flatten_stripes(merge_stripes(got, none, row_limit=limit)), "term1", "term2", "n") == rows(flatten_stripes(got), "term1", "term2", "n")


def test_a_null_first_term_has_its_own_rows(spark):
    pairs = spark.createDataFrame([(None, "a", 1), ("", "a", 2), (None, "b", 3), ("x", "a", 4)], "term1 string, term2 string, n long")
    got = {(r["term1"], r["part"]): r["stripe"] for r in stripes_from_pairs(pairs, row_limit=9).collect()}
    assert got == {(None, 0): {"a": 1, "b": 3}, ("", 0): {"a": 2}, ("x", 0): {"a": 4}}


def test_cells_count_every_pair(spark, monkeypatch):
    # small cells: more of them than classes of ids; repeats, copies of a line, a long line
    monkeypatch.setattr(text, "CELL_PAIRS", 50)
    lines = ["a b a c", "a b a c", " ".join(f"t{i % 37}" for i in range(120)), "z", ""]
    want = Counter()
    for line in lines:
        w = line.split()
        want.update((w[i], w[j]) for i in range(len(w)) for j in range(i + 1, len(w)))
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    got = text.cooccurrence(df)
    assert {(r["term1"], r["term2"]): r["n"] for r in got.collect()} == want


def test_pairs_are_not_shuffled(spark):
    # what is shuffled are places of contexts by cell; no exchange has pairs
    df = spark.createDataFrame([("a b c d",)], "text string")
    p = text.cooccurrence(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(r#" in p
    assert "Exchange hashpartitioning(term1" not in p and "Exchange hashpartitioning(id1" not in p
