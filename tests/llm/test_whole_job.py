"""Operators do the whole job: what bounds and short cuts once left out."""

import random

import numpy as np
import pytest

import corpus_pipeline
from setgraph.llm import sentencepiece as pieces
from setgraph.llm.langid import fit, identify_languages, keep_identified
from setgraph.llm.line_dedup import dedup_lines
from setgraph.llm.minhash import drop_near_duplicates
from setgraph.llm.secret_scan import scan_text
from setgraph.llm.toxicity import Model, Scores, once

from .conftest import SF, plain, prose
from .test_line_dedup import brute, edited


def test_short_lines_lose_exact_repeats_in_the_pipeline(spark):
    line = prose(5, 9)
    docs = [(1, f"All rights reserved.\n{line}\n\n", "x"), (2, f"{line}\nAll rights reserved.", "x"), (3, "All rights reserve\n \n\n", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = plain(corpus_pipeline.line_dedup(spark, df, SF).select("doc_id", "text"))
    # blank lines stay, one edit makes no copy of a short line, and a text of repeats alone goes
    assert got == [(1, f"All rights reserved.\n{line}\n\n"), (3, "All rights reserve\n \n\n")]


def test_short_exact_against_brute_force(spark):
    r = random.Random(4)
    pool = [prose(50 + i, r.randrange(5, 9)) for i in range(8)] + ["short", "shirt", "}", "All rights reserved.", "two words"]
    pool += [edited(r, x) for x in pool if len(x) > 24]
    docs = {i: "\n".join(r.choice(pool) for _ in range(r.randrange(1, 8))) for i in range(30)}
    got = plain(dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string")))
    assert got == brute(docs)


INSULTS = [f"insult{c}" for c in "abcdef"]


def toxic_model():
    return Model({w: 3.0 for w in INSULTS}, 1.0, 0.0, (-2.0, 2.0))


def significant(text):
    words, found = text.split(), toxic_model().significant(text, Scores(toxic_model().log_odds))[0]
    return [words[a:b] for a, b, _ in found]


def test_every_passage_of_a_long_text_is_found():
    filler = prose(3, 40)
    scattered = " ".join(f"{w} {filler}" for w in INSULTS)
    dense = " ".join(INSULTS)
    assert significant(scattered) == []
    assert significant(f"{scattered} {dense}") == [INSULTS]  # its words stand before, one by one
    assert significant(f"{dense} {filler} {dense}") == [INSULTS, INSULTS]  # a second copy
    assert significant(" ".join(INSULTS[:1] * 50)) == []  # one word over and over


def test_best_part_against_definition():
    rng = np.random.default_rng(5)
    for _ in range(200):
        score = {w: float(x) for w, x in zip("abcdef", rng.normal(0.5, 2.0, 6))}
        words = [str(w) for w in rng.choice(list(score), rng.integers(1, 14))]
        best = 0.0
        for i in range(len(words)):
            for j in range(i, len(words)):
                part = words[i:j + 1]
                best = max(best, sum(-0.7 if score[w] > 0 and w in part[:k] else score[w] for k, w in enumerate(part)))
        assert abs(once(words, np.array([score[w] for w in words])) - best) < 1e-9


def test_every_labelled_language_is_learned(spark):
    rows, r = [], random.Random(6)
    for k in range(70):  # each language has its own letters; the last ones are the rarest
        letters = [chr(0x4E00 + 8 * k + i) for i in range(8)]
        for _ in range(12 if k < 64 else 6):
            text = " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 6))) for _ in range(40))
            rows.append((len(rows), text, f"l{k:02d}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df)
    assert model.languages == [f"l{k:02d}" for k in range(70)]
    pred = {x["doc_id"]: x["lang_pred"] for x in identify_languages(df, model).collect()}
    assert all(pred[i] == lang for i, _, lang in rows if lang >= "l64")
    assert sum(pred[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    a, b, c = prose(11, 80), prose(12, 80), prose(13, 80)
    rows = [(1, a, "x"), (5, f"{a} more", "x"), (5, b, "x"),      # an id on two texts, one of them a near copy of row 1
            (None, "", "x"), (None, f"{b} more", "x"),            # a NULL id with an empty text, and a near copy of row 5
            (7, c, "y"), (7, c, "x"), (7, c, "x"), (None, f"{c} more", "x"), (8, None, "x"), (8, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = [(1, a, "x"), (5, b, "x"), (None, "", "x"), (7, c, "x"), (8, None, "x")]
    kept = drop_near_duplicates(df)
    assert kept.schema == df.schema and plain(kept) == sorted(want, key=repr)


def test_clean_text_of_three_languages_is_kept(spark):
    rows, r = [], random.Random(8)
    parts = []
    for k in range(4):
        letters = [chr(0x4E00 + 8 * k + i) for i in range(8)]
        made = [" ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 6))) for _ in range(40)) for _ in range(60)]
        rows += [(len(rows) + i, t, f"l{k}") for i, t in enumerate(made)]
        parts.append(made[0])
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, " ".join(parts[:3]), None), (2, "12 --", None)], "doc_id long, text string, lang string")
    assert identify_languages(df, model).where("doc_id = 1").first()["score"] < 0.5
    assert [x["doc_id"] for x in keep_identified(df, model).collect()] == [1]


def test_a_word_has_more_segmentations_than_eight_and_cached_ones_are_exact(monkeypatch):
    with open(pieces.default_model(), "rb") as f:
        v = pieces.Vocabulary(f.read())
    text = " ".join(["internationalization"] * 400 + ["of"] * 50 + prose(4, 60).split())
    e = pieces.Encoder(v, 0.2)
    ids = e.encode([3], [text])[0]
    assert e.decode(ids) == text
    cut, word = set(), []
    for i in ids.tolist():
        if v.bytes[i][:1] == b" " and word:
            cut.add(tuple(word))
            word = []
        word.append(i)
    assert sum(b"".join(v.bytes[i] for i in c) == b" internationalization" for c in cut) > 8
    # all occurrences one by one give the same
    monkeypatch.setattr(pieces.Encoder, "_skips", lambda self, word, *_: np.ones(len(word), dtype=bool))
    assert np.array_equal(e.encode([3], [text])[0], ids)


@pytest.mark.parametrize("text", [
    "$db_pass = 'Zx81-qq7!Lm2';",
    "$k = 'Zx81-qq7!Lm2';\n$db_pwd = $k;",
    "my $pwd = 'Zx81-qq7!Lm2';",
    "config['db_pwd'] = 'Zx81-qq7!Lm2'",
    '$cfg["db"]["pass"] = "Zx81-qq7!Lm2";',
    "$h{'pwd'} = 'Zx81-qq7!Lm2';",
    "db_pwd: str = 'Zx81-qq7!Lm2'",
    "db_pwd: str | None = 'Zx81-qq7!Lm2'",
    "db_pwd: Optional[str] = 'Zx81-qq7!Lm2'",
    "const pwd: string = 'Zx81-qq7!Lm2'",
    "const PWD: &'static str = \"Zx81-qq7!Lm2\";",
    'var pwd string = "Zx81-qq7!Lm2"',
    'const string pwd = "Zx81-qq7!Lm2";',
    "INFO: pwd = 'Zx81-qq7!Lm2'",
    "k: str = 'Zx81-qq7!Lm2'\npwd = k",
])
def test_secrets_in_common_source_forms(text):
    assert [text[a:b] for a, b, k in scan_text(text) if k == "literal"] == ["Zx81-qq7!Lm2"]


def test_no_secrets_from_forms_of_other_names():
    for text in ("title: str = 'Zx81-qq7!Lm2'\ndef f(pwd: str):", "$title = 'Zx81-qq7!Lm2';", "x['title'] = 'Zx81-qq7!Lm2'"):
        assert scan_text(text) == []
