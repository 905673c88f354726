"""Hard negatives against a brute-force ranking; the threshold's stop; odd rows."""

import math
import random

import numpy as np
import pytest

from setgraph.llm.hard_negatives import Lists, hard_negatives, window_of

from .conftest import plain

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x string"


def brute(rows, every=50):
    use = []
    for k, (i, v, label) in enumerate(rows):
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            use.append((k, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for k, i, label, v in use:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, n, lab) for n, j, lab, w in use if n != k)
        for s, j, _, _ in [r for r in scored if r[3] == label][:5]:
            fit = [r for r in scored if r[3] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(i, j, rank, r[1], -s, -r[0]) for rank, r in enumerate(fit, 1)]
    return sorted(out)


def table(r, n, dims, values):
    rows = []
    for _ in range(n):
        i = r.choice([r.randrange(400), r.randrange(20) * 50, r.randrange(60) * 7])
        rows.append((i, [values(r) for _ in range(dims)], r.randrange(4)))
    return rows


@pytest.mark.parametrize("seed,values", [
    (1, lambda r: r.gauss(0, 1)), (2, lambda r: r.choice([0.0, 0.5, 1.0])), (3, lambda r: r.choice([-1.0, 0.0, 0.0, 1.0]))])
def test_rows_are_those_of_brute_force(spark, seed, values):
    r = random.Random(seed)
    rows = table(r, 260, 6, values)
    rows += rows[:15]                                    # repeated rows
    rows += [(None, [1.0] * 6, 1), (700, None, 1), (750, [1.0] * 6, None), (800, [1.0, None] * 3, 1),
             (850, [math.nan] * 6, 1), (900, [math.inf] * 6, 1), (950, [], 2), (1000, [1.0] * 3, 2), (1050, [0.0] * 6, 2)]
    docs = spark.createDataFrame([(*x, "a", None) for x in rows], SCHEMA)
    want = brute(rows)
    assert plain(hard_negatives(docs)) == sorted(want, key=repr) and want
    # cut into many blocks and groups
    assert plain(hard_negatives(docs, block=20, group=3)) == sorted(want, key=repr)


def test_search_stops_early_and_is_exact():
    r = np.random.default_rng(4)
    x = r.integers(-200, 200, size=(3000, 4))
    lists = Lists(np.arange(3000), list(x), 4)
    anchor = np.array([150, -60, 0, 9])
    allowed = r.random(3000) < 0.5
    scores = x @ anchor
    top = scores.max()
    windows = [(-math.inf, math.inf), window_of(int(top))]
    best, _, seen = lists.search(anchor, allowed, windows, 3)
    for found, (low, high) in zip(best, windows):
        fit = [i for i in np.flatnonzero(allowed) if low <= scores[i] <= high]
        assert found.tolist() == sorted(fit, key=lambda i: (-scores[i], i))[:3]
    assert seen < 2000


def test_ties_go_on_until_the_threshold_is_below():
    lists = Lists(np.array([9, 3, 7, 1, 5]), [np.array([2, 2])] * 5, 2)
    best, _, _ = lists.search(np.array([1, 1]), np.ones(5, dtype=bool), [(-math.inf, math.inf)], 2)
    assert lists.ids[best[0]].tolist() == [1, 3]


def test_huge_components_are_scored_exactly():
    big = 2 ** 61
    lists = Lists(np.array([1, 2]), [np.array([big, -big]), np.array([big, -big + 1])], 2)
    _, scores, _ = lists.search(np.array([big, big]), np.ones(2, dtype=bool), [(-math.inf, math.inf)], 2)
    assert scores.tolist() == [0, big]


def test_windows_round_inwards():
    assert window_of(101) == (51, 95) and window_of(0) == (0, 0) and window_of(-10) == (-5, -10)


def test_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(1, [1.0], 1, "", "")], SCHEMA)).count() == 0
