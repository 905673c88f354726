import pytest
from pyspark.sql import functions as F

from setgraph.operators import paths, shortest_paths_to
from setgraph.session import in_session
from setgraph.sources import order_edges

from .brute import shortest_to
from .conftest import SF_SMALL, rows
from .test_edges import SCHEMA, TINY

# expected (dist, path) per target and node, tie rule (dist, hops, next)
EXPECTED = {
    0: {0: (0.0, "0"), 1: (7.0, "1->2->4->0"), 2: (4.0, "2->4->0"), 3: (6.0, "3->4->0"), 4: (2.0, "4->0")},
    1: {0: (10.0, "0->1"), 1: (0.0, "1"), 2: (3.0, "2->1"), 3: (16.0, "3->4->0->1"), 4: (12.0, "4->0->1")},
    2: {0: (13.0, "0->1->2"), 1: (3.0, "1->2"), 2: (0.0, "2"), 3: (19.0, "3->4->0->1->2"),
        4: (15.0, "4->0->1->2")},
    3: {0: (11.0, "0->1->3"), 1: (1.0, "1->3"), 2: (4.0, "2->1->3"), 3: (0.0, "3"), 4: (6.0, "4->3")},
    4: {0: (15.0, "0->1->2->4"), 1: (5.0, "1->2->4"), 2: (2.0, "2->4"), 3: (4.0, "3->4"), 4: (0.0, "4")},
}


def _result(df):
    return {r["node"]: (r["dist"], "->".join(map(str, r["path"])), r["hops"]) for r in df.collect()}


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame(TINY, SCHEMA)


@pytest.mark.parametrize("target", sorted(EXPECTED))
def test_tiny_graph_all_targets(spark, tiny, target):
    got = _result(shortest_paths_to(tiny, target))
    assert {k: v[:2] for k, v in got.items()} == EXPECTED[target]
    assert all(v[2] == v[1].count("->") for v in got.values())


def test_salted_hubs_same_result(spark, tiny):
    assert _result(shortest_paths_to(tiny, 0, salt_edges=1)) == _result(shortest_paths_to(tiny, 0))


def test_edge_cases(spark):
    e = [(0, 5, 5, 1.0),            # self-loop
         (1, 6, 5, 4.0), (2, 6, 5, 2.0),  # parallel edges
         (3, 7, 8, 0.0), (4, 8, 7, 0.0), (5, 8, 5, 3.0),  # zero-weight cycle 7<->8
         (6, 9, 10, 1.0)]           # 9 cannot reach 5
    df = spark.createDataFrame(e, SCHEMA)
    got = _result(shortest_paths_to(df, 5))
    assert got == {5: (0.0, "5", 0), 6: (2.0, "6->5", 1), 8: (3.0, "8->5", 1), 7: (3.0, "7->8->5", 2)}
    # target without an incoming edge: empty result
    assert shortest_paths_to(df, 9).count() == 0
    assert shortest_paths_to(df, 12345).count() == 0


def test_negative_weight_rejected(spark):
    df = spark.createDataFrame([(0, 1, 2, -1.0), (1, 2, 3, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="non-negative"):
        shortest_paths_to(df, 3).collect()


def test_distances_only(spark, tiny):
    d = shortest_paths_to(tiny, 3, with_path=False)
    assert d.columns == ["node", "dist", "hops"]
    assert rows(d, "node", "dist") == [(0, 11.0), (1, 1.0), (2, 4.0), (3, 0.0), (4, 6.0)]


def test_order_item_graph_against_dijkstra(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    e = order_edges(li)
    edges = [(r.src, r.dst, r.dist) for r in e.collect()]
    target = edges[0][1]
    expected = shortest_to(edges, target)
    got = _result(shortest_paths_to(e, target))
    assert set(got) == set(expected)
    for v, (d, h, path) in expected.items():
        assert got[v][0] == d and got[v][2] == h and got[v][1] == "->".join(map(str, path))
    # invariants: path weight equals dist; every path suffix is itself a row
    w = {}
    for s, d, x in edges:
        w[(s, d)] = min(x, w.get((s, d), float("inf")))
    for v, (d, p, h) in got.items():
        nodes = [int(x) for x in p.split("->")]
        assert sum(w[(a, b)] for a, b in zip(nodes, nodes[1:])) == d
        assert got[nodes[1]][1] == "->".join(map(str, nodes[1:])) if len(nodes) > 1 else True


def test_stable_under_partitioning(spark, tiny):
    a = _result(shortest_paths_to(tiny.repartition(3), 0))
    b = _result(shortest_paths_to(tiny.orderBy(F.desc("edge_id")).coalesce(1), 0))
    assert a == b


def test_null_ends_rejected(spark):
    for e in ([(0, None, 2, 1.0)], [(0, 1, None, 1.0)]):
        with pytest.raises(Exception, match="null"):
            shortest_paths_to(spark.createDataFrame(e, SCHEMA), 2).collect()


def test_cheaper_path_with_more_hops(spark):
    df = spark.createDataFrame([(0, 0, 1, 1.0), (1, 1, 2, 1.0), (2, 2, 3, 1.0), (3, 0, 3, 10.0)], SCHEMA)
    assert _result(shortest_paths_to(df, 3))[0] == (3.0, "0->1->2->3", 3)


def test_star_and_chain(spark):
    star = spark.createDataFrame([(i, i, 0, 1.0) for i in range(1, 200)], SCHEMA)
    assert all(v == ((0.0, "0", 0) if n == 0 else (1.0, f"{n}->0", 1)) for n, v in _result(shortest_paths_to(star, 0)).items())
    chain = spark.createDataFrame([(i, i + 1, i, 2.0) for i in range(20)], SCHEMA)
    got = _result(shortest_paths_to(chain, 0))
    assert len(got) == 21 and got[20] == (40.0, "->".join(map(str, range(20, -1, -1))), 20)


@pytest.fixture(scope="module")
def parts(spark):
    return order_edges(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")).checkpoint()


def test_distance_buckets_and_merged_deltas_give_the_same_rows(spark, parts, monkeypatch):
    want = _result(shortest_paths_to(parts, 1))
    assert _result(shortest_paths_to(parts, 1, bucket=3.0)) == want
    monkeypatch.setattr(paths, "DELTAS", 0)     # every delta merged to one
    assert _result(shortest_paths_to(parts, 1)) == want


@pytest.mark.parametrize("bucket", [None, 2.0])
def test_a_new_driver_goes_on_after_the_last_round(spark, tmp_path, monkeypatch, bucket):
    edges = spark.createDataFrame([(i, i + 1, i, 1.0) for i in range(5)] + [(9, 5, 0, 4.5), (10, 7, 5, 0.0)], SCHEMA)
    want = {i: (float(i), "->".join(map(str, range(i, -1, -1))), i) for i in range(5)} | {5: (4.5, "5->0", 1), 7: (4.5, "7->5->0", 2)}
    folder, relax, calls = str(tmp_path / "rounds"), paths._relax, []

    def lost(*args):
        calls.append(1)
        if len(calls) > 2:
            raise RuntimeError("driver lost")
        return relax(*args)

    monkeypatch.setattr(paths, "_relax", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        shortest_paths_to(edges, 0, bucket=bucket, state_dir=folder)
    monkeypatch.setattr(paths, "_relax", relax)
    monkeypatch.setattr(paths, "prepare_edges", None)      # nothing is prepared again
    other = in_session(edges, spark.newSession())
    assert _result(shortest_paths_to(other, 0, bucket=bucket, state_dir=folder)) == want
    with pytest.raises(ValueError, match="target"):
        shortest_paths_to(other, 2, state_dir=folder)


def test_rounds_write_what_they_improve(spark, tmp_path):
    # a chain: every round improves one node of 10
    chain = spark.createDataFrame([(i, i + 1, i, 1.0) for i in range(9)], SCHEMA)
    folder = tmp_path / "rounds"
    assert shortest_paths_to(chain, 0, with_path=False, state_dir=str(folder)).count() == 10
    sizes = {p.name: spark.read.parquet(str(p)).count() for p in folder.iterdir() if p.name.startswith("delta-")}
    assert len(sizes) == 9 and set(sizes.values()) == {1}
    # the base is written anew when half of it has changed, not every round
    assert len([p for p in folder.iterdir() if p.name.startswith("base-")]) <= 3


def test_chain_and_star(spark):
    n = 300
    # all of a star wait for one end, far from the target
    e = [(i, i + 1, i, 1.0) for i in range(6)] + [(10 + i, 100 + i, 6, 2.0) for i in range(n)]
    df = spark.createDataFrame(e, SCHEMA)
    d = paths.shortest_distances(df, 0)
    want = {r["node"]: r["path"] for r in paths.assemble_paths(d).collect()}
    assert want[100] == [100, 6, 5, 4, 3, 2, 1, 0] and len(want) == n + 7


def test_size_estimates_do_not_grow_with_the_rounds(spark):
    # a chain of 24 rounds: estimates that multiply in every round had millions of digits
    chain = spark.createDataFrame([(i, i + 1, i, 1.0) for i in range(24)], SCHEMA)
    d = paths.shortest_distances(chain, 0)
    assert d.count() == 25
    assert len(str(d._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 20


def test_hubs_alone_are_salted(spark):
    star = spark.createDataFrame([(i, i, 0, 1.0) for i in range(1, 40)] + [(50, 7, 3, 1.0)], SCHEMA)
    e, salts = paths.prepare_edges(star, salt_edges=10)
    assert rows(salts, "node", "salts") == [(0, 4), (3, 1)]
    assert {r["salt"] for r in e.where("dst = 0").collect()} == {0, 1, 2, 3} and e.count() == 40
