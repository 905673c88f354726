import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from setgraph.operators import paircells, text

from .conftest import rows


def _counts(lines):
    out = Counter()
    for line in lines:
        w = line.split()
        out.update((w[i], w[j]) for i in range(len(w)) for j in range(i + 1, len(w)))
    return out


def _batch(lines):
    h = [[hash((s, x)) for x in lines] for s in (1, 2)]
    return pa.RecordBatch.from_arrays([pa.array(lines), pa.array(h[0], pa.int64()), pa.array(h[1], pa.int64())], names=["line", "h1", "h2"])


@pytest.mark.parametrize("side, part, firsts", [(1, 1 << 20, 1 << 21), (3, 4, 5), (4, 50, 1)])
def test_numpy_cells_count_every_pair(monkeypatch, side, part, firsts):
    # blocks, classes and parts of any size; copies in one block and over blocks
    monkeypatch.setattr(paircells, "BLOCK_BYTES", 300)
    monkeypatch.setattr(paircells, "PART", part)
    monkeypatch.setattr(paircells, "FIRSTS", firsts)
    monkeypatch.setattr(paircells, "OUT_BYTES", 100)
    r = random.Random(side)
    lines = [" ".join(f"t{int(r.paretovariate(0.6)) % 50}" for _ in range(r.randrange(14))) for _ in range(150)]
    lines += [lines[3]] * 40 + ["x y x"] * 9 + [" ".join(f"u{i % 23}" for i in range(130)), "z", "", None]
    blocks = [paircells._block(k, pa.Table.from_batches(b)) for k, b in enumerate(paircells._slices(iter([_batch(lines[:90]), _batch(lines[90:])])))]
    assert len(blocks) > 5
    freq = Counter()
    for b in blocks:
        freq.update(dict(zip(b["terms"], b["counts"].tolist())))
    number = {t: i for i, (t, _) in enumerate(freq.most_common())}
    first, weight = {}, Counter()   # of a context over all blocks
    for b in blocks:
        for place, key in enumerate(zip(b["h1"].tolist(), b["h2"].tolist())):
            first.setdefault(key, (b["block"], place))
            weight[key] += int(b["w"][place])
    cells = {}
    for b in blocks:
        own = [(at[1], weight[key]) for key, at in first.items() if at[0] == b["block"]]
        if not own:
            continue
        row = pa.RecordBatch.from_pydict({
            "block": [b["block"]], "ids": [[number[t] for t in b["terms"]]], "places": [[x[0] for x in own]], "weights": [[x[1] for x in own]],
            "n": [b["n"]], "rows": [len(b["h1"])], "sizes": [b["sizes"]], "codes": [b["codes"]]})
        for out in paircells._dealer(side)(iter([row])):
            cells.setdefault((out.column("r")[0].as_py(), out.column("c")[0].as_py()), []).append(out)
    got = Counter()
    for (a, c), found in cells.items():
        piece = lambda k: " ".join(t for t, i in number.items() if i % side == k)
        head = [pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([a, c, kind, 0, piece(k), [], None, None, None, None, None], paircells._CELL)],
                                           schema=paircells._CELL) for kind, k in ((0, a), (1, c))[:1 if a == c else 2]]
        for out in paircells._count_pairs(iter(head + found)):
            for x in out.to_pylist():
                assert (x["term1"], x["term2"]) not in got      # a pair is counted in one cell, once
                got[x["term1"], x["term2"]] = x["n"]
    assert got == _counts([x for x in lines if x])


def test_packed_numbers_come_back():
    for x in (np.zeros(0, np.int64), np.arange(5), np.array([0, 255, 256, 1 << 24, (1 << 32) - 1])):
        assert paircells.unpack(paircells.pack(x), len(x)).tolist() == x.tolist()


def test_a_term_travels_as_few_bytes(spark):
    # cooccurrence_documents wrote and shuffled eight bytes and more for each place of a term, per class
    r = random.Random(5)
    lines = [(" ".join(f"w{int(r.paretovariate(0.7)) % 3000}" for _ in range(60)),) for _ in range(2000)]
    df = spark.createDataFrame(lines, "text string")
    blocks = paircells.pack_contexts(text.contexts(df, "text"))
    side = paircells._sides(blocks, text.CELL_PAIRS)
    n = blocks.agg(F.sum("n")).first()[0]
    assert n == 120_000
    assert blocks.agg(F.sum(F.length("codes") + F.length("sizes"))).first()[0] < 2 * n
    dealt = paircells.cells_of(blocks, paircells.vocabulary(blocks), text.CELL_PAIRS).where("kind = 2")
    assert dealt.agg(F.sum(F.length("codes") + F.length("sizes") + F.length("w"))).first()[0] < 2 * side * n


def test_copies_in_several_blocks_count_once_each(spark):
    df = spark.createDataFrame([("p q p",)] * 50 + [("q r",)] * 3, "text string").repartition(7)
    assert rows(text.cooccurrence(df)) == [("p", "p", 50), ("p", "q", 50), ("q", "p", 50), ("q", "r", 3)]


def test_stripes_of_terms_beyond_the_limit_are_full(spark):
    # lists of several cells, cut by places: rows but a term's last are full, keys in byte order
    r = random.Random(8)
    lines = [" ".join(r.choice([f"k{i}" for i in range(70)] + ["é", "zz"]) for _ in range(r.randrange(2, 12))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    got = {}
    for x in text.cooccurrence_stripes(df, row_limit=9).select("term1", "part", F.map_entries("stripe").alias("e")).collect():
        got.setdefault(x["term1"], {})[x["part"]] = [tuple(e) for e in x["e"]]
    want = _counts(lines)
    assert {(a, b): n for a, parts in got.items() for e in parts.values() for b, n in e} == want
    for parts in got.values():
        e = [parts[p] for p in range(len(parts))]
        assert all(len(x) == 9 for x in e[:-1]) and 0 < len(e[-1]) <= 9
        keys = [k.encode() for x in e for k, _ in x]
        assert keys == sorted(keys)


def test_merged_stripes_keep_any_key(spark):
    # keys with spaces and tildes, terms with one row and with several
    one = [("a", 0, {"x y": 1, "~0": 2}), ("h", 0, {"a": 1, "b b": 1}), ("h", 1, {"c": 4}), ("only", 0, {"": 1})]
    two = [("a", 0, {"x y": 5, "~1": 7}), ("h", 0, {"b b": 3, "d": 1}), ("h", 1, {"~": 9})]
    a, b = (spark.createDataFrame(t, "term1 string, part long, stripe map<string,long>").checkpoint() for t in (one, two))
    got = {(r["term1"], r["part"]): r["stripe"] for r in text.merge_stripes(a, b, row_limit=2).collect()}
    assert got == {("a", 0): {"x y": 6, "~0": 2}, ("a", 1): {"~1": 7}, ("h", 0): {"a": 1, "b b": 4}, ("h", 1): {"c": 4, "d": 1},
                   ("h", 2): {"~": 9}, ("only", 0): {"": 1}}
