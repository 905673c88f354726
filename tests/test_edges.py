import pytest

from setgraph.operators import incoming_edge_avg, min_edges, reverse_adjacency

from .conftest import rows

# tiny graph (edge_id, src, dst, dist)
TINY = [(0, 0, 1, 10.0), (1, 1, 2, 3.0), (2, 1, 3, 1.0), (3, 2, 1, 3.0), (4, 2, 0, 5.0),
        (5, 2, 3, 9.0), (6, 2, 4, 2.0), (7, 3, 4, 4.0), (8, 4, 0, 2.0), (9, 4, 3, 6.0)]
SCHEMA = "edge_id long, src long, dst long, dist double"


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame(TINY, SCHEMA)


def test_incoming_edge_avg_tiny(spark, tiny):
    got = dict(rows(incoming_edge_avg(tiny)))
    assert got == pytest.approx({0: 3.5, 1: 6.5, 2: 3.0, 3: 16 / 3, 4: 3.0})
    assert incoming_edge_avg(tiny).schema.simpleString() == "struct<node:bigint,avg_dist:double>"


def test_truncated_zero_filter(spark):
    # node averages 0.89, 0.0, -0.5, -1.5, NaN
    e = [(0, 9, 1, 0.89), (1, 9, 2, 1.0), (2, 8, 2, -1.0), (3, 9, 3, -0.5), (4, 9, 4, -1.5),
         (5, 9, 5, float("nan"))]
    df = spark.createDataFrame(e, SCHEMA)
    assert [r[0] for r in rows(incoming_edge_avg(df))] == [1, 2, 3, 4, 5]
    assert rows(incoming_edge_avg(df, drop_truncated_zero=True)) == [(4, -1.5)]


def test_reverse_adjacency(spark, tiny):
    extra = spark.createDataFrame([(10, 2, 1, 1.5)], SCHEMA)  # parallel edge 2->1, shorter
    adj = reverse_adjacency(tiny.unionByName(extra))
    got = {r["node"]: (r["in_degree"], [(x["src"], x["dist"]) for x in r["in_edges"]])
           for r in adj.collect()}
    assert got == {0: (2, [(2, 5.0), (4, 2.0)]), 1: (2, [(0, 10.0), (2, 1.5)]), 2: (1, [(1, 3.0)]),
                   3: (3, [(1, 1.0), (2, 9.0), (4, 6.0)]), 4: (2, [(2, 2.0), (3, 4.0)])}


@pytest.mark.parametrize("ids", [range(1, 11), range(4, 404, 4), [-7 * i for i in range(1, 30)], [5]])
def test_reverse_adjacency_bounds_every_list(spark, ids):
    edges = [(i, i, d, float(abs(i))) for i in ids for d in (0, 10 ** 9)] + [(0, 3, -2, 1.0)]
    df = spark.createDataFrame(edges, SCHEMA)
    limit = 25 if len(ids) > 25 else 3
    parts = reverse_adjacency(df, row_limit=limit).collect()
    assert all(0 < len(r["in_edges"]) <= limit for r in parts)
    flat = sorted((r["node"], x["src"], x["dist"]) for r in parts for x in r["in_edges"])
    assert flat == rows(min_edges(df), "dst", "src", "dist")
    for node in (0, 10 ** 9):
        own = sorted((r["part"], [x["src"] for x in r["in_edges"]]) for r in parts if r["node"] == node)
        assert [p for p, _ in own] == list(range(len(own)))
        assert [x for _, xs in own for x in xs] == sorted(ids)
        assert {r["in_degree"] for r in parts if r["node"] == node} == {len(ids)}
