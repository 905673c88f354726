"""Named queries over the shared parquet tables: name -> (spark, sf_dir) -> DataFrame.

Each query runs one operator of the library over whole tables.  Column names
and types match the DuckDB statements in :mod:`setgraph.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import path_string
from ..operators import edges as edge_ops
from ..operators import paths as path_ops
from ..operators import setsim, text
from ..session import checkpoint_dir, compact_checkpoint, configure, reliable_checkpoint
from ..sources import readers, sinks
from ..sources.tables import order_edges, table, text_sets

# Fixed query parameters.
TARGET = 1          # shortest-path target node (a part key)
T_DOCS = 0.8        # similarity threshold over documents
T_LOW = 0.1         # similarity threshold over benchmark items
STRIPE_PART = 8     # second terms in a row of the flattened stripes
STRIPE_MERGE = 4096  # second terms in a row of the merged stripes

Query = Callable[[SparkSession, str], DataFrame]


def _docs_sets(spark: SparkSession, sf: str) -> DataFrame:
    return text_sets(table(spark, sf, "documents"), "doc_id")


def _bench_sets(spark: SparkSession, sf: str) -> DataFrame:
    return text_sets(table(spark, sf, "benchmark"), "item_id")


def _edges(spark: SparkSession, sf: str, signed: bool = False) -> DataFrame:
    return order_edges(table(spark, sf, "lineitem"), signed=signed)


def terms_benchmark(spark, sf):
    return text.terms(table(spark, sf, "benchmark"), "text", keys=["item_id"])


def word_count(spark, sf):
    return text.word_count(table(spark, sf, "documents"), "text")


def cooccurrence_pairs(spark, sf):
    return text.cooccurrence(table(spark, sf, "conversations"), "text", context="line")


def cooccurrence_documents(spark, sf):
    # long lines (thousands of terms): exercises the chunked pair expansion
    return text.cooccurrence(table(spark, sf, "documents"), "text", context="line")


def cooccurrence_rows(spark, sf):
    return text.cooccurrence(table(spark, sf, "benchmark"), "text", context="row")


def cooccurrence_stripes(spark, sf):
    s = text.cooccurrence_stripes(table(spark, sf, "conversations"), "text", context="line")
    total = F.aggregate(F.map_values("stripe"), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return s.groupBy("term1").agg(F.sum(F.size("stripe")).cast("int").alias("n_terms"), F.sum(total).alias("n_total"))


def cooccurrence_stripes_merged(spark, sf):
    # the stripes of each half of the conversations, merged
    rows = table(spark, sf, "conversations")
    odd = F.coalesce(F.col("conv_id"), F.lit(0)) % 2 != 0
    halves = [compact_checkpoint(text.cooccurrence_stripes(half, "text", context="line", row_limit=STRIPE_MERGE))
              for half in (rows.where(odd), rows.where(~odd))]
    return text.flatten_stripes(text.merge_stripes(*halves, row_limit=STRIPE_MERGE))


def cooccurrence_stripes_flat(spark, sf):
    return text.flatten_stripes(text.cooccurrence_stripes(
        table(spark, sf, "benchmark"), "text", context="row", row_limit=STRIPE_PART))


def word_count_lines(spark, sf):
    return text.word_count(table(spark, sf, "documents"), "text").select(sinks.kv_line("term", "n").alias("line"))


def cooccurrence_lines(spark, sf):
    return text.cooccurrence(table(spark, sf, "benchmark"), "text", context="row").select(
        sinks.kv_line(text.pair_key(), "n").alias("line"))


def path_lines(spark, sf):
    return path_ops.shortest_paths_to(_edges(spark, sf), TARGET).select(sinks.path_line().alias("line"))


def edges_from_lines(spark, sf):
    # line items as edge lines, the id not a number, parsed back
    li = table(spark, sf, "lineitem")
    value = F.concat_ws(" ", F.concat(F.lit("e"), F.col("l_orderkey")), "l_partkey", "l_suppkey", F.col("l_quantity").cast("string"))
    return readers.parse_edges(li.select(value.alias("value"))).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n"), F.min("dist").alias("dist"))


def sets_from_lines(spark, sf):
    # the customers' order keys as set lines with trailing spaces, parsed back
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderkey")).alias("k"))
    value = F.concat(F.col("o_custkey"), F.lit(" "), F.array_join(F.transform("k", lambda x: x.cast("string")), " "), F.lit(" "))
    sets = readers.parse_sets(orders.select(value.alias("value")))
    return sets.select("rid", F.explode("tokens").alias("token"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage of the checkpoints."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def word_count_files(spark, sf):
    # the documents written as text files, read as lines
    folder = _folder(spark, "lines")
    table(spark, sf, "documents").where(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("value")).write.text(folder)
    return text.word_count(readers.read_lines(spark, folder), "value")


def word_count_sorted(spark, sf):
    folder = _folder(spark, "counts")
    sinks.write_kv(text.word_count(table(spark, sf, "documents"), "text"), folder, "term", "n")
    return sinks.read_kv(spark, folder, "term").withColumnRenamed("value", "line")


def path_lines_sorted(spark, sf):
    folder = _folder(spark, "paths")
    sinks.write_paths(path_ops.shortest_paths_to(_edges(spark, sf), TARGET), folder)
    return sinks.read_paths(spark, folder).withColumnRenamed("value", "line")


def pair_lines_sorted(spark, sf):
    folder = _folder(spark, "pairs")
    sinks.write_pairs(setsim.set_similarity_join(_bench_sets(spark, sf), T_LOW), folder)
    return sinks.read_pairs(spark, folder).withColumnRenamed("value", "line")


def edge_rejects(spark, sf):
    # line items as edge lines, some cut short and some with a field that is no number
    folder, li = _folder(spark, "edges"), table(spark, sf, "lineitem")
    src = F.when(F.col("l_orderkey") % 97 == 0, F.lit("none")).otherwise(F.col("l_partkey").cast("string"))
    dist = F.when(F.col("l_partkey") % 89 == 0, F.lit("far")).otherwise(F.col("l_quantity").cast("string"))
    head = F.concat_ws(" ", F.col("l_orderkey").cast("string"), src, F.col("l_suppkey").cast("string"))
    value = F.when(F.col("l_suppkey") % 83 == 0, head).otherwise(F.concat_ws(" ", head, dist))
    li.select(value.alias("value")).write.text(folder)
    good, rejects, _ = readers.read_edges_checked(spark, folder)
    good = good.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("good").alias("reason"), F.concat_ws(" ", "src", "dst").alias("line"), "n")
    return good.unionByName(rejects.groupBy("reason", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n")))


def set_rejects(spark, sf):
    # the customers' order keys as set lines, some blank, some with tokens that are no numbers
    folder = _folder(spark, "sets")
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderkey")).alias("k"))
    rid = F.when(F.col("o_custkey") % 31 == 0, F.concat(F.lit("c"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    tail = F.when(F.col("o_custkey") % 29 == 0, F.lit(" x")).otherwise(F.lit(" "))
    value = F.concat(rid, F.lit(" "), F.array_join(F.transform("k", lambda x: x.cast("string")), " "), tail)
    value = F.when(F.col("o_custkey") % 37 == 0, F.lit("  ")).otherwise(value)
    orders.select(value.alias("value")).write.text(folder)
    sets, rejects, _ = readers.read_sets_checked(spark, folder)
    good = sets.select(F.lit("good").alias("reason"), F.col("rid").cast("string").alias("line"), F.size("tokens").cast("long").alias("n"))
    return good.unionByName(rejects.groupBy("reason", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n")))


def incoming_edge_avg(spark, sf):
    return edge_ops.incoming_edge_avg(_edges(spark, sf))


def incoming_edge_avg_signed_truncated(spark, sf):
    return edge_ops.incoming_edge_avg(_edges(spark, sf, signed=True), drop_truncated_zero=True)


def reverse_adjacency(spark, sf):
    adj = edge_ops.reverse_adjacency(_edges(spark, sf))
    entry = lambda x: F.concat(x["src"].cast("string"), F.lit(":"),
                               x["dist"].cast("long").cast("string"))
    return adj.select("node", "part", "in_degree",
                      F.array_join(F.transform("in_edges", entry), ",").alias("in_edges"))


def shortest_dist(spark, sf):
    return path_ops.shortest_paths_to(_edges(spark, sf), TARGET, with_path=False)


def shortest_paths(spark, sf):
    p = path_ops.shortest_paths_to(_edges(spark, sf), TARGET, with_path=True)
    return p.select("node", "dist", "hops", path_string("path").alias("path"))


def token_ranks(spark, sf):
    return setsim.token_ranks(setsim.set_records(_docs_sets(spark, sf)))


def _docs_records(spark: SparkSession, sf: str) -> DataFrame:
    # the token sets feed several branches (frequencies, prefixes, both join
    # sides): tokenize the corpus once
    return reliable_checkpoint(setsim.set_records(_docs_sets(spark, sf)))


def prefix_tokens(spark, sf):
    return setsim.prefix_tokens(_docs_records(spark, sf), T_DOCS)


def similarity_candidates(spark, sf):
    return setsim.similarity_candidates(_docs_records(spark, sf), T_DOCS)


def set_similarity_join(spark, sf):
    return setsim.set_similarity_join(_docs_sets(spark, sf), T_DOCS)


def set_similarity_join_given_order(spark, sf):
    # rank-encoded records: token ids follow the global order, so the join
    # uses them as given, without its own frequency stage
    enc = setsim.rank_encode(_docs_records(spark, sf))
    return setsim.set_similarity_join(enc, T_DOCS, order="given", positional=True)


def set_similarity_join_positional(spark, sf):
    return setsim.set_similarity_join(_docs_sets(spark, sf), T_DOCS, positional=True)


def set_similarity_low(spark, sf):
    return setsim.set_similarity_join(_bench_sets(spark, sf), T_LOW)


def pair_lines(spark, sf):
    return setsim.set_similarity_join(_bench_sets(spark, sf), T_LOW).select(
        sinks.pair_line().alias("line"))


def _configured(q: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return q(configure(spark), sf)
    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


QUERIES: dict[str, Query] = {
    "terms_benchmark": terms_benchmark,
    "word_count": word_count,
    "cooccurrence_pairs": cooccurrence_pairs,
    "cooccurrence_stripes": cooccurrence_stripes,
    "cooccurrence_documents": cooccurrence_documents,
    "cooccurrence_rows": cooccurrence_rows,
    "incoming_edge_avg": incoming_edge_avg,
    "incoming_edge_avg_signed_truncated": incoming_edge_avg_signed_truncated,
    "reverse_adjacency": reverse_adjacency,
    "shortest_dist": shortest_dist,
    "shortest_paths": shortest_paths,
    "token_ranks": token_ranks,
    "prefix_tokens": prefix_tokens,
    "similarity_candidates": similarity_candidates,
    "set_similarity_join": set_similarity_join,
    "set_similarity_join_given_order": set_similarity_join_given_order,
    "set_similarity_join_positional": set_similarity_join_positional,
    "set_similarity_low": set_similarity_low,
    "pair_lines": pair_lines,
    "cooccurrence_stripes_flat": cooccurrence_stripes_flat,
    "cooccurrence_stripes_merged": cooccurrence_stripes_merged,
    "word_count_lines": word_count_lines,
    "cooccurrence_lines": cooccurrence_lines,
    "path_lines": path_lines,
    "edges_from_lines": edges_from_lines,
    "sets_from_lines": sets_from_lines,
    "word_count_files": word_count_files,
    "word_count_sorted": word_count_sorted,
    "path_lines_sorted": path_lines_sorted,
    "pair_lines_sorted": pair_lines_sorted,
    "edge_rejects": edge_rejects,
    "set_rejects": set_rejects,
}
QUERIES = {name: _configured(q) for name, q in QUERIES.items()}
