"""Mixing: targets by hand, balance, copies, levels and odd rows."""

import random

from setgraph.llm.mixing import Flight, mix_sources

from .conftest import plain


def targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by resharing the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        share = total - sum(capped.values())
        got = {s: share * w[s] / sum(w[r] for r in rest) for s in rest}
        above = [s for s in rest if got[s] > most * sizes[s]]
        if not above:
            return {**got, **capped}
        capped |= {s: most * sizes[s] for s in above}


def corpus(spark, sizes, seed=1):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate((s, n) for s in sizes for n in sizes[s])]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_stop_at_three_times_a_source(spark):
    sizes = {"a": [10, 4], "b": [700, 50], "c": [1], "é": [300], "\U0001f600": [20], None: [33]}
    want = targets({s: sum(n) for s, n in sizes.items()})
    got = {r["source"]: r["target"] for r in mix_sources(corpus(spark, sizes)).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert want["a"] == 42 and want["c"] == 3       # both above their shares


def check(rows, near):
    by = {}
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        by.setdefault(r["source"], []).append(r)
    for rs in by.values():
        target, docs = rs[0]["target"], len(rs) * rs[0]["target"] / max(1, rs[0]["source_size"])
        assert rs[0]["source_size"] == sum(r["size"] for r in rs)
        assert abs(sum(r["taken"] for r in rs) - target) <= near, (rs[0]["source"], target, sum(r["taken"] for r in rs))
        assert abs(sum(r["copies"] for r in rs) - docs) <= 0.25 * docs + 3


def test_words_and_documents_come_near_their_totals(spark):
    r = random.Random(3)
    sizes = {s: [int(r.paretovariate(1.2) * 5) % 900 + 1 for _ in range(300)] for s in "abcdef"}
    docs = corpus(spark, sizes)
    check(mix_sources(docs).collect(), 12)
    # in many parts and levels, too; small parts cannot make good a large document, of which half is owed at most
    check(mix_sources(docs, part=40).collect(), max(n for of in sizes.values() for n in of) / 2)


def test_reruns_agree_whatever_the_layout(spark):
    sizes = {s: [3 + i % 17 for i in range(80)] for s in "ab"}
    docs = corpus(spark, sizes)
    docs = docs.unionByName(docs.limit(40))
    assert plain(mix_sources(docs)) == plain(mix_sources(docs.repartition(7)))


def test_flight_keeps_totals_and_expectations():
    r, n = random.Random(5), 4000
    sizes = [r.randrange(1, 60) for _ in range(12)]
    took = [0] * len(sizes)
    for _ in range(n):
        flight, out = Flight(sum(sizes), True), {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            out |= dict(flight.add(0.5, sizes[i], r.random(), i))
        out |= dict(flight.end())
        assert set(out.values()) <= {0.0, 1.0} and len(out) == len(sizes)
        # the last document by its probability, the flight's random numbers reused at the end
        assert abs(sum(sizes[i] * p for i, p in out.items()) - sum(sizes) / 2) <= max(sizes)
        took = [t + out[i] for i, t in enumerate(took)]
    assert all(abs(t / n - 0.5) < 0.12 for t in took), took


def test_a_document_that_outweighs_its_source(spark):
    # 5000 words or none would miss the target by more than all others can mend
    rows = mix_sources(corpus(spark, {"a": [5000] + [2] * 30, "b": [300] * 20})).collect()
    for s in "ab":
        of = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 5000 / 2 + 300


def test_odd_rows_and_empty_table(spark, odd, none):
    odd, none = (t.withColumnRenamed("lang", "source").withColumn("size", t.line_no).withColumn("copy", t.shard) for t in (odd, none))
    got = mix_sources(odd)
    assert got.count() == odd.count() and mix_sources(none).count() == 0
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == sorted(r["doc_id"] for r in odd.collect() if r["doc_id"] is not None)
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mix_sources(empty).collect()] == [(0, 0.0, 0)] * 2
