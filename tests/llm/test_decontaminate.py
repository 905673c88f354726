import random

import numpy as np

from setgraph.llm.common import shingles
from setgraph.llm.decontaminate import contaminations, coordinates, drop_contaminated, size_class, sketch_keys

from .conftest import plain, prose
from .test_minhash import word_sets


def brute(docs, items):
    out = set()
    for i, t in docs:
        for k, s in items:
            a, b = word_sets(t), word_sets(s)
            if b and 100 * len(a & b) >= 75 * len(b):
                out.add((i, k, len(a & b), len(b), len(a & b) / len(b)))
    return sorted(out)


def test_against_brute_force(spark):
    r = random.Random(2)
    items = [(k, prose(k, r.choice([3, 5, 8, 20, 60, 300]))) for k in range(40)] + [(40, prose(0, 5)), (41, None), (42, "")]
    docs = []
    for i in range(120):
        words = prose(1000 + i, r.choice([2, 10, 200, 3000])).split(" ")
        if i % 2:
            body = items[r.randrange(40)][1].split(" ")
            cut = r.choice([0, 0, len(body) // 8, len(body) // 3])
            at = r.randrange(len(words) + 1)
            words[at:at] = body[cut:]
        docs.append((i, " ".join(words)))
    docs += [(k + 200, t) for k, t in items[:5]] + [(300, None), (301, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert plain(contaminations(d, b)) == sorted(want, key=repr) and len(want) > 30
    left = {x[0] for x in docs} - {w[0] for w in want}
    assert {r["doc_id"] for r in drop_contaminated(d, b).collect()} == left


def test_sketches_find_items_in_large_sets():
    rng, missed = np.random.default_rng(4), 0
    for _ in range(300):
        q = int(rng.choice([8, 20, 40, 200]))
        item = np.unique(rng.integers(0, 2 ** 63, q).astype(np.uint64))
        rest = rng.integers(0, 2 ** 63, int(rng.choice([100, 5000, 40000]))).astype(np.uint64)
        doc = np.unique(np.concatenate([item[: -(-3 * len(item) // 4)], rest]))
        c, k = size_class(len(doc)), size_class(len(item))
        missed += not len(np.intersect1d(sketch_keys(doc, c, k), sketch_keys(item, c, k)))
    assert missed == 0
    assert coordinates(20, 9) and coordinates(20, 9) < 2 ** 20 and coordinates(20, 0) == 0


def test_odd_rows(spark, odd, none):
    bench = odd.withColumnRenamed("doc_id", "item_id")
    got = plain(contaminations(odd, bench).select("doc_id", "item_id"))
    assert (1, 2) in got and (2, 1) in got and (10, 1) in got and (None, None) in got and (8, 9) in got
    assert not any(x[0] in (3, 4, 5) or x[1] in (3, 4, 5) for x in got)
    assert len(got) == len(set(got))
    kept = drop_contaminated(odd, bench)
    assert kept.schema == odd.schema and {r["doc_id"] for r in kept.collect()} == {3, 4, 5, None}
    assert contaminations(none, bench).count() == 0 and contaminations(odd, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert drop_contaminated(odd, none.withColumnRenamed("doc_id", "item_id")).count() == odd.count()


def test_shingle_sets_are_equal_to_words():
    t = "Alpha beta\x0bgamma  delta\tepsilon zeta"
    assert len(shingles(t)) == len(word_sets(t)) == 2
