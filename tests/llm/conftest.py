import random

import pytest

from setgraph.llm.common import prepare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, score string, line_no long, shard int, node string, kept string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, words: int = 60) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randrange(2, 9))) for _ in range(words))


def plain(df):
    """All rows as tuples, sorted by their text (rows may hold nulls)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and
    columns whose names clash with those of the operators."""
    long_text = " ".join(prose(i, 500) for i in range(60)) + "\n" + "x" * 50_000
    rows = [(1, prose(1)), (2, prose(1)), (2, prose(1)), (3, None), (None, prose(2)), (4, ""), (5, " \t\n "), (6, long_text),
            (7, "12 34 --"), (None, None), (8, "one two"), (9, "ONE two"), (10, prose(1) + "\n" + prose(2)), (11, "▁ é 日本 😀\r\n")]
    rows = [(i, t, *( ("en", "s", 3, 4, "n", "k") if k % 2 else (None,) * 6)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
