"""Physical-plan properties the operators are designed for."""

import re

from pyspark.sql import functions as F

from setgraph.operators import paths, text
from setgraph.plans import QUERIES
from setgraph.session import in_session, partitioned_checkpoint
from setgraph.sources import order_edges

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_count_prunes_and_combines(spark):
    p = _plan(QUERIES["word_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in p
    assert "partial_count" in p


def test_edges_are_derived_once(spark):
    e, salts = paths.prepare_edges(order_edges(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")))
    for df in (e, salts):
        assert "FileScan" not in _plan(df) and "Window" not in _plan(df)


def test_no_round_robin_before_the_edge_window(spark):
    for name in ("incoming_edge_avg", "incoming_edge_avg_signed_truncated"):
        assert "RoundRobin" not in _plan(QUERIES[name](spark, SF_SMALL)), name
    # the others cut their lineage: look at the edges that they start from
    assert "RoundRobin" not in _plan(order_edges(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")))


def test_lists_are_shuffled_once(spark):
    # above the collect there is no exchange by the key alone, and none of the lists
    from setgraph.operators import reverse_adjacency
    e = order_edges(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    pairs = text.cooccurrence(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"), "text", context="row")
    for df, entries in ((reverse_adjacency(e), "in_edges"), (text.stripes_from_pairs(pairs), "stripe")):
        p = _plan(df)
        assert re.search(r"Exchange hashpartitioning\(_key#\d+L?, _null#\d+, _cut#\d+L?", p)
        above = p[:p.index("collect_list(")] if "collect_list(" in p else p
        assert not re.search(r"Exchange[^\n]*\n[^\n]*" + entries, above)
        for line in p.split("\n"):
            if "Exchange hashpartitioning(_key" in line and "_cut" not in line:
                at = p.index(line)
                assert "collect_list" not in p[at:at + 400]


def test_hot_keys_are_looked_up_by_broadcast(spark):
    from setgraph.operators.ranking import split_lookup
    rows = spark.range(5000).select(F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("token"), "id")
    table = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", F.monotonically_increasing_id()).checkpoint()
    got = split_lookup(rows, table, "token", "n", hot_keys=8)
    assert sorted(r["id"] for r in got.collect()) == list(range(5000))
    assert all(r["rank"] is not None for r in got.collect())
    # only the hot key is below the bound, and its rows meet it without a shuffle
    shuffled = got.where(F.col("token") != "hot").count()
    assert shuffled == 1667 or shuffled == 1666
    assert "BroadcastExchange" in _plan(got)


def test_relaxation_round_moves_only_frontier_and_candidates(spark):
    e = order_edges(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    pe, salts = paths.prepare_edges(e)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = salts.select("node", F.struct(F.lit(0.0).alias("d"), F.lit(0).alias("h"),
                                         F.lit(None).cast("long").alias("nx")).alias("c"), "salts")
    base = partitioned_checkpoint(base.repartition(n, "node"))
    delta = partitioned_checkpoint(paths._relax(base, [], base, pe))
    p = _plan(paths._relax(base, [delta], delta, pe))
    # one exchange for the frontier, one for the candidates; edges, base and deltas stay put
    assert p.count("Exchange hashpartitioning") == 2
    assert "ShuffledHashJoin" in p and "SortMergeJoin" not in p


def test_pair_expansion_keeps_its_partition_count(spark):
    df = spark.createDataFrame([("a b c d",)], "text string")
    p = _plan(text.cooccurrence(df))
    assert "REPARTITION_BY_NUM" in p


def test_no_estimate_based_broadcast(spark):
    # static broadcast is off in the recommended settings: a broadcast can only
    # appear after AQE has measured a side
    for name in ("set_similarity_join", "prefix_tokens", "incoming_edge_avg"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "isFinalPlan=false" in p
        initial = p.split("isFinalPlan=false", 1)[1]
        assert "BroadcastExchange" not in initial.replace("BroadcastExchange IdentityBroadcastMode", ""), name
