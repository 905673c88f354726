"""Term counting and term co-occurrence over text contexts.

Plans are pure DataFrame expressions: explode -> partial HashAggregate ->
Exchange -> final HashAggregate.  Hot terms and repeated lines are collapsed by
map-side partial aggregation before any shuffle; long lines are split into
chunks so that the quadratic pair expansion of one line spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from ..functions.text import split_lines, tokenize
from ..session import compact_checkpoint, reliable_checkpoint
from .paircells import count_pairs, count_stripes
from .ranking import cut_lists

# First-term positions handled per task-level chunk of a long context.  A chunk
# carries the context from its first position on, so a context of n terms ships
# about n^2 / (2 CHUNK) terms for its n^2 / 2 pairs.
CHUNK = 1024

# Tasks of the pair expansion per shuffle partition.  Its input is small (one row
# per chunk) and the work after it quadratic, so it is not coalesced by size.
EXPANSION_TASKS = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def terms(df: DataFrame, col: str = "text", keys: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row per term occurrence: ``keys..., line_no INT, pos INT, term STRING``.

    ``line_no`` and ``pos`` are 0-based (line within the text, term within the line).
    """
    keys = list(keys)
    lines = explode_rows(df, split_lines(col), "line", *keys, pos="line_no")
    out = explode_rows(lines, tokenize("line"), "term", *keys, "line_no", pos="pos")
    return out.select(*keys, F.col("line_no").cast("int"), F.col("pos").cast("int"), "term")


def word_count(df: DataFrame, col: str = "text") -> DataFrame:
    """``term STRING, n LONG``: occurrences of every term."""
    t = explode_rows(df, tokenize(col), "term")
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def contexts(df: DataFrame, col: str = "text", context: str = "line") -> DataFrame:
    """``terms ARRAY<STRING>`` per co-occurrence context (a line, or a whole row)."""
    if context == "line":
        lines = explode_rows(df, split_lines(col), "line")
        return lines.select(tokenize("line").alias("terms"))
    if context == "row":
        return df.select(tokenize(col).alias("terms"))
    raise ValueError(f"context must be 'line' or 'row', got {context!r}")


def _weighted_contexts(df: DataFrame, col: str, context: str) -> DataFrame:
    """``terms, w``: distinct contexts with at least two terms and their count.
    Identical contexts (repeated lines, copied documents) are expanded once;
    partial aggregation merges hot copies map-side."""
    ctx = contexts(df, col, context).where(F.size("terms") >= 2)
    return ctx.groupBy("terms").agg(F.count(F.lit(1)).alias("w"))


def _chunks(weighted: DataFrame, chunk: int = CHUNK, col: str = "terms") -> DataFrame:
    """``w, firsts, rest``: a context of k terms gives one row for each ``chunk`` of
    its first-term positions, with the terms from the chunk's start on."""
    starts = F.sequence(F.lit(0), F.floor((F.size(col) - 2) / F.lit(chunk)).cast("int"))
    parts = F.transform(starts, lambda c: F.slice(col, c * F.lit(chunk) + 1, F.size(col)))
    return weighted.select("w", F.explode(parts).alias("rest"))


def _pairs(weighted: DataFrame, chunk: int = CHUNK, col: str = "terms") -> DataFrame:
    """``term1, term2, n`` from ``(terms ARRAY, w)`` contexts (terms as strings
    or as ids): every position pair i < j adds ``w`` to (terms[i], terms[j]).

    The chunks of a long context are dealt to different tasks.
    """
    tasks = EXPANSION_TASKS * int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = _chunks(weighted, chunk, col).repartition(tasks, F.xxhash64("rest"))
    firsts = chunks.select("w", "rest", F.posexplode(F.slice("rest", 1, F.lit(chunk))).alias("k", "term1"))
    pairs = firsts.select("w", "term1", F.explode(F.slice("rest", F.col("k") + 2, F.size("rest"))).alias("term2"))
    return pairs.groupBy("term1", "term2").agg(F.sum("w").alias("n"))


# Pairs of a cell and direction, repeats counted, beyond which the cells are made smaller.
CELL_PAIRS = 1 << 28


def cooccurrence(df: DataFrame, col: str = "text", context: str = "line",
                 chunk: int = CHUNK, encode: bool = True) -> DataFrame:
    """Ordered co-occurrence counts ``term1 STRING, term2 STRING, n LONG``.

    For every context with terms t_0..t_{k-1}, every position pair i < j adds
    one to (t_i, t_j); repeats are kept, so (a, a) can occur.

    The contexts are packed into compressed blocks of term numbers, which are materialised
    once, and their pairs counted in cells (:mod:`setgraph.operators.paircells`), which
    know the terms of their numbers.  ``encode=False`` counts on the strings, without a dictionary, a context's
    first terms in chunks of ``chunk``; it gives the same rows and saves passes over
    the terms where lines are short.
    """
    if not encode:
        return _pairs(reliable_checkpoint(_weighted_contexts(df, col, context)), chunk)
    return count_pairs(contexts(df, col, context), CELL_PAIRS)


# Most second terms that one stripe row holds.
STRIPE_ROW = 65_536


def stripes_from_pairs(pairs: DataFrame, row_limit: int = STRIPE_ROW) -> DataFrame:
    """``term1 STRING, part LONG, stripe MAP<STRING,LONG>`` with second terms in byte order.

    The pairs are numbered in the order (term1, term2) and cut every ``row_limit``
    places: a row holds consecutive second terms of one first term, at most
    ``row_limit`` of them, and ``part`` counts a term's rows from 0.
    """
    lists = cut_lists(pairs.select("term1", "term2", "n"), "term1", "term2", name="stripe", row_limit=row_limit,
                      entries=F.map_from_entries(F.sort_array(F.collect_list(F.struct("term2", "n")))))
    return lists.select("term1", "part", "stripe")


def _packed(stripe: str = "stripe") -> list[Column]:
    """``keys, ns``: a map's keys as one text, which takes a fourth of an array's bytes, and its values."""
    safe = F.transform(F.map_keys(stripe), lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit(" "), F.lit("~1")))
    return [F.array_join(safe, " ").alias("keys"), F.map_values(stripe).alias("ns")]


def _keys(text: Column | str) -> Column:
    return F.transform(F.split(_col(text), " "), lambda k: F.replace(F.replace(k, F.lit("~1"), F.lit(" ")), F.lit("~0"), F.lit("~")))


def _added(pieces: DataFrame) -> DataFrame:
    """``term1, range, e``: the entries of the pieces ``(term1, range, keys, ns)`` of a range, counts added, in order."""
    add = lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    maps = F.transform("c", lambda x: F.map_from_arrays(_keys(x["keys"]), x["ns"]))
    return pieces.groupBy("term1", "range").agg(F.collect_list(F.struct("keys", "ns")).alias("c")).select(
        "term1", "range", F.sort_array(F.map_entries(F.aggregate(maps, empty, add))).alias("e"))


# Rows of a narrow table up to which it is sent to all tasks.
BROADCAST_ROWS = 1 << 18


def _here(narrow: DataFrame) -> DataFrame:
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_ROWS else narrow


def merge_stripes(stripes: DataFrame, more: DataFrame, row_limit: int = STRIPE_ROW) -> DataFrame:
    """Stripes of two inputs as those of both: ``term1, part, stripe`` with the counts added.

    Nothing goes back to pairs.  Terms with one row in each table are added whole, in one
    shuffle.  For the others the first keys of both tables' rows cut a term's second
    terms into ranges, of which a row of either table covers some whole ones; so a range
    meets at most one piece of each table, and their maps are added.  The ranges'
    sizes, a narrow table, say which places a range takes among its term's; pieces are
    cut at the multiples of ``row_limit`` and put together again, so every row but a
    term's last holds ``row_limit`` second terms.
    """
    tables = [t.select("term1", "part", "stripe") for t in (stripes, more)]
    limit, entries = F.lit(row_limit), lambda e: F.map_from_entries(e).alias("stripe")
    long = reliable_checkpoint(tables[0].unionByName(tables[1]).where(F.col("part") > 0).select("term1").distinct())
    cut = _here(long)
    whole = _added(tables[0].unionByName(tables[1]).join(cut, "term1", "left_anti").where(F.size("stripe") > 0).select(
        "term1", F.lit(0).cast("long").alias("range"), *_packed()))
    whole = whole.select("term1", "e", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.size("e") - 1) / limit).cast("long"))).alias("part")).select(
        "term1", "part", entries(F.slice("e", (F.col("part") * limit + 1).cast("int"), limit)))
    if long.isEmpty():
        return whole

    tables = [t.join(cut, "term1", "left_semi").where(F.size("stripe") > 0) for t in tables]
    ends = [reliable_checkpoint(t.select("term1", "part", F.map_keys("stripe")[0].alias("lo"), F.element_at(F.map_keys("stripe"), -1).alias("hi")))
            for t in tables]    # narrow: a row's first and last key
    starts = ends[0].unionByName(ends[1]).groupBy("term1").agg(F.sort_array(F.collect_set("lo")).alias("starts"))
    pieces = None
    for t, covers in zip(tables, ends):
        before = lambda x: F.size(F.filter("starts", lambda s: s <= F.col(x)))
        ranges = covers.join(starts, "term1").select("term1", "part", "starts", F.explode(F.sequence(before("lo") - 1, before("hi") - 1)).alias("range"))
        ranges = reliable_checkpoint(ranges.select("term1", "part", F.col("range").cast("long").alias("range"), F.get("starts", F.col("range")).alias("lo"),
                                                   F.get("starts", F.col("range") + 1).alias("hi")))
        some = t.join(_here(ranges), ["term1", "part"]).select("term1", "range", F.map_filter(
            "stripe", lambda k, v: (k >= F.col("lo")) & (F.col("hi").isNull() | (k < F.col("hi")))).alias("m")).where(F.size("m") > 0)
        some = some.select("term1", "range", *_packed("m"))
        pieces = some if pieces is None else pieces.unionByName(some)
    merged = compact_checkpoint(_added(pieces).select("term1", "range", F.size("e").alias("size"), F.map_from_entries("e").alias("m")).select(
        "term1", "range", "size", *_packed("m")))
    offset = F.sum("size").over(Window.partitionBy("term1").orderBy("range")) - F.col("size")
    places = reliable_checkpoint(merged.select("term1", "range", "size", offset.cast("long").alias("at")).drop("size"))
    at, size = F.col("at"), F.size("ns")
    parts = F.sequence(F.floor(at / limit).cast("long"), F.floor((at + size - 1) / limit).cast("long"))
    placed = merged.join(_here(places), ["term1", "range"]).select("term1", "range", "at", _keys("keys").alias("k"), "ns", F.explode(parts).alias("part"))
    first, many = F.greatest(at, F.col("part") * limit), F.least(at + size, (F.col("part") + 1) * limit)
    chunk = lambda c: F.slice(c, (first - at + 1).cast("int"), (many - first).cast("int"))
    chunks = placed.select("term1", "part", "range", F.map_from_arrays(chunk("k"), chunk("ns")).alias("m")).select("term1", "part", "range", *_packed("m"))
    rows = chunks.groupBy("term1", "part").agg(F.sort_array(F.collect_list(F.struct("range", "keys", "ns"))).alias("c"))
    keys, ns = F.flatten(F.transform("c", lambda c: _keys(c["keys"]))), F.flatten(F.transform("c", lambda c: c["ns"]))
    return whole.unionByName(rows.select("term1", "part", F.map_from_arrays(keys, ns).alias("stripe")))


def cooccurrence_stripes(df: DataFrame, col: str = "text", context: str = "line",
                         chunk: int = CHUNK, encode: bool = True, row_limit: int = STRIPE_ROW) -> DataFrame:
    """Stripe form of :func:`cooccurrence`: maps of later terms per first term, in rows of
    at most ``row_limit``.  The cells of the pairs give them; with ``encode=False``
    :func:`stripes_from_pairs` does."""
    if encode:
        return count_stripes(contexts(df, col, context), CELL_PAIRS, row_limit)
    # written once: the sort of the pairs reads them twice
    return stripes_from_pairs(reliable_checkpoint(cooccurrence(df, col, context, chunk, encode)), row_limit)


def flatten_stripes(stripes: DataFrame) -> DataFrame:
    """Back to pair rows ``term1, term2, n``."""
    return stripes.select("term1", F.explode("stripe").alias("term2", "n"))


def pair_key(term1: Column | str = "term1", term2: Column | str = "term2") -> Column:
    """The composite text key ``term1 term2`` of a pair."""
    return F.concat_ws(" ", _col(term1), _col(term2))
