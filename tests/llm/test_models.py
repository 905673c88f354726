"""Toxicity, language ID, SentencePiece, sharding and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from setgraph.llm import langid
from setgraph.llm import sentencepiece as pieces
from setgraph.llm.minhash import near_duplicates
from setgraph.llm.langid import fit, identify_languages, keep_identified, label_words, marginals
from setgraph.llm.sharding import difference, shard_by_bytes
from setgraph.llm.toxicity import fit as fit_toxicity
from setgraph.llm.toxicity import score_toxicity, segments, toxic_passages

from .conftest import SF, plain, prose

SF1 = "/root/testdata/sf0.01"


def brute_segments(s):
    """Maximal segments by their definition: the best, then those left and right of it."""
    best, at = 0.0, None
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            x = float(sum(s[i:j]))
            if x > best + 1e-9 or (at and abs(x - best) <= 1e-9 and j - i < at[1] - at[0] and at[0] <= i and j <= at[1]):
                best, at = x, (i, j)
    if at is None:
        return []
    i, j = at
    return brute_segments(s[:i]) + [(i, j, best)] + [(a + j, b + j, x) for a, b, x in brute_segments(s[j:])]


def test_segments_against_definition():
    rng = np.random.default_rng(2)
    for n in range(1, 26):
        for _ in range(12):
            s = rng.normal(-0.2, 1.0, n)
            got, want = segments(s), brute_segments(s.tolist())
            assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])
    assert segments(np.empty(0)) == []


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 for r in rows)
    found = toxic_passages(docs, fit_toxicity(docs, labels)).limit(5).collect()
    assert found and all(r["passage"] and r["first_token"] < r["end_token"] for r in found)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (2, 0, 1), (None, 1, 0), (6, None, None)], "doc_id long, toxic int, quality int")
    got = plain(score_toxicity(odd, labels).select("doc_id", "held_out", "predicted"))
    assert len(got) == odd.count() and {x[0] for x in got} == {r[0] for r in odd.select("doc_id").collect()}
    assert score_toxicity(none, labels.limit(0)).count() == 0 and score_toxicity(odd, labels.limit(0)).count() == odd.count()


def test_forward_backward_against_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 0, 4, 2])
    scores, steps = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got, at = marginals(scores, lengths, steps), 0
    for n in lengths:
        want, total = np.zeros((n, 3)), 0.0
        for path in product(range(3), repeat=int(n)):
            w = np.exp(sum(scores[at + i, y] for i, y in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, y in enumerate(path):
                want[i, y] += w
        assert np.allclose(got[at:at + n], want / total)
        at += n


@pytest.fixture(scope="module")
def language_model(spark):
    return fit(spark.read.parquet(f"{SF1}/documents.parquet"))


def test_languages_of_held_out_rows(spark, language_model):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    rows = identify_languages(docs, language_model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    # code-switched text: half English, half German words of held-out documents
    cut = {x: " ".join(docs.where((F.col("lang") == x) & (F.length("text") > 900)).orderBy("doc_id").first()["text"].split()[:60]) for x in ("en", "de")}
    df = spark.createDataFrame([(1, f"{cut['en']} {cut['de']}")], "doc_id long, text string")
    words = label_words(df, language_model).orderBy("word_no").collect()
    n, k = len(words), len(langid.words(cut["en"]))
    assert [w["word_no"] for w in words] == list(range(n)) and 20 < k < n - 20
    assert sum(w["lang"] == "en" for w in words[:k]) > 0.8 * k and sum(w["lang"] == "de" for w in words[k:]) > 0.8 * (n - k)


def test_language_odd_rows(spark, odd, none, language_model):
    got = plain(identify_languages(odd, language_model).select("doc_id", "lang_pred", "score"))
    assert len(got) == odd.count()
    assert {x for x in got if x[0] in (3, 4, 5, 7)} == {(i, "und", 0.0) for i in (3, 4, 5, 7)}
    kept = keep_identified(odd, language_model)
    assert kept.schema == odd.schema and not {r["doc_id"] for r in kept.collect()} & {3, 4, 5, 7}
    assert identify_languages(none).count() == 0 and keep_identified(none).count() == 0
    assert {r["lang_pred"] for r in identify_languages(odd.drop("lang").withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.fixture(scope="module")
def model():
    with open(pieces.default_model(), "rb") as f:
        return f.read()


TEXTS = [None, "", " ", "  a", "a  ", "日本語テキスト😀", "x" * 300, "a\n\n b\t c\r\n", "foo   bar      baz", "né́e \x00 \x0b", prose(1, 300),
         "\n", " \n ", "word" * 40, "1234567890" * 5]


def test_pieces_without_dropout_are_the_library_s(model):
    sp, e = SentencePieceProcessor(model_proto=model), pieces.Encoder(pieces.Vocabulary(model), 0.0)
    for t, ids in zip(TEXTS, e.encode(list(range(len(TEXTS))), TEXTS)):
        assert ids.tolist() == sp.encode(t or "")


def test_dropout_is_seeded_varied_and_lossless(model, monkeypatch):
    v = pieces.Vocabulary(model)
    texts = [*TEXTS, "a▁b ▁▁ c", "same words " * 200]
    keys = list(range(len(texts)))
    e = pieces.Encoder(v, 0.2)
    ids = e.encode(keys, texts)
    assert [e.decode(x) for x in ids] == [t or "" for t in texts]
    assert all((a == b).all() for a, b in zip(ids, pieces.Encoder(v, 0.2).encode(keys, texts)))
    other = pieces.Encoder(v, 0.2, epoch=1).encode(keys, texts)
    assert not np.array_equal(ids[-1], other[-1]) and e.decode(other[-1]) == texts[-1]
    assert len({tuple(ids[-1][i:i + 3]) for i in range(len(ids[-1]) - 2)}) > 10  # equal words are cut in several ways
    alone = [pieces.Encoder(v, 0.2).encode([k], [t])[0] for k, t in zip(keys, texts)]
    assert all(np.array_equal(a, b) for a, b in zip(ids, alone))  # whatever else is in the batch
    monkeypatch.setattr(pieces, "LONG", 0)
    assert all(np.array_equal(a, b) for a, b in zip(ids, e.encode(keys, texts)))  # the heap gives the same
    monkeypatch.setattr(pieces, "BLOCK", 50)
    assert [e.decode(x) for x in e.encode(keys, texts)] == [t or "" for t in texts]


def test_piece_odd_rows(spark, odd, none):
    rows = pieces.encode_texts(odd)
    assert rows.where("lossless").count() == odd.count() and pieces.encode_texts(none).count() == 0
    back = {(r["doc_id"], r["text"]) for r in pieces.decode_texts(rows).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()}


def test_differencing_balances():
    rng = np.random.default_rng(0)
    for n in (1, 5, 400):
        sums = np.zeros((n, 6), dtype=np.int64)
        sums[:, 0] = rng.integers(1, 10_000, n)
        final, place = difference(sums)
        got = np.zeros(6, dtype=np.int64)
        np.add.at(got, place[:, 0], sums[:, 0])
        assert (got == final).all() and (np.diff(final) <= 0).all()
    assert final[0] - final[-1] < 20
    # two-way differencing by hand: 8 7 6 5 4 -> 16 and 14
    two = np.zeros((5, 2), dtype=np.int64)
    two[:, 0] = [8, 7, 6, 5, 4]
    assert difference(two)[0].tolist() == [16, 14]


def check_shards(rows, docs):
    assert sorted(r["doc_id"] or -1 for r in rows) == sorted(d[0] or -1 for d in docs)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    text = {d[0]: d[1] for d in docs}
    of = {}
    for r in rows:
        assert of.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"] and 0 <= r["shard"] < 24
        assert r["size"] == len((text[r["doc_id"]] or "").encode()) + 8 and r["law"] == "bytes" and r["grown_shard"] is None


@pytest.mark.parametrize("bounds", [{}, {"bucket_groups": 40, "bucket_partitions": 3}])
def test_shards(spark, bounds):
    r = random.Random(1)
    docs = [(i, "é" * r.randrange(0, 3000)) for i in range(900)] + [(i, "copy of one text") for i in range(1000, 1200)] + [(2000, None), (2001, None)]
    got = shard_by_bytes(spark.createDataFrame(docs, "doc_id long, text string"), **bounds).collect()
    check_shards(got, docs)
    sums = [sum(x["size"] for x in got if x["shard"] == s) for s in range(24)]
    assert max(sums) - min(sums) < (0.05 if bounds else 0.001) * max(sums)


def test_shard_odd_rows(spark, odd, none):
    got = shard_by_bytes(odd).collect()
    assert len(got) == odd.count() and len({x["shard"] for x in got if x["doc_id"] in (1, 2)}) == 1
    assert all(x["text_crc32"] == 0 and x["size"] == 8 for x in got if x["doc_id"] in (3, 4))
    assert shard_by_bytes(none).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10 ** 6, "s", "en", 3, "-- 1"), (10 ** 6 + 1, None, None, None, None), (10 ** 6 + 2, None, "en", 0, "")]
    now, sizes = docs.unionByName(spark.createDataFrame(extra, "doc_id long, source string, lang string, n_chars long, text string")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        if name != "tokenize":
            assert out.columns == docs.columns, name
        now = out.checkpoint()
        sizes.append(now.count())
    assert sizes[0] <= docs.count() and sizes[1] <= sizes[0] and sizes[2] <= sizes[1] and sizes[3] < sizes[2] and sizes[4] == sizes[3]
    assert now.where("NOT lossless").count() == 0
    # no row is left whose lines all stand elsewhere, and no whole copy: of a near copy only lines of its own
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {r["doc_id"]: r["n_pieces"] for r in now.collect()}
    copies = [r["doc_id"] for r in near_duplicates(docs).where("NOT kept").collect()]
    assert copies and all(left[i] or not (text.get(i) or "").strip() for i in left)
    seen = {line for i, t in text.items() if i not in copies and t for line in t.split("\n")}
    for i in copies:
        assert i not in left or any(line.strip() and line not in seen for line in text[i].split("\n"))
    assert plain(corpus_pipeline.run(spark, SF)) == plain(now)


def test_languages_are_found_piece_by_piece(monkeypatch):
    rng = np.random.default_rng(3)
    model = langid.Model(["a", "b"], {}, rng.normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros((2, 2), np.float32), np.eye(2, dtype=np.float32))
    texts = ["".join(rng.choice(list("abc "), 40)) for _ in range(30)] + [None, "", "x" * 500, "a b"]
    whole, sizes, labelled = langid._languages(texts, model), [], langid._labelled
    monkeypatch.setattr(langid, "PIECE", 100)
    monkeypatch.setattr(langid, "_labelled", lambda part, m: sizes.append(sum(len(x or "") for x in part)) or labelled(part, m))
    names, scores, sure = langid._languages(texts, model)
    assert names == whole[0] and np.allclose(scores, whole[1], atol=1e-5) and np.allclose(sure, whole[2], atol=1e-5)
    assert len(sizes) > 10 and sorted(sizes)[-2] <= 100 and max(sizes) == 500
