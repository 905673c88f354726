"""DuckDB statements that compute the same results as :mod:`setgraph.plans.catalog`.

They run over the same parquet tables (registered as views by name) and are
the correctness oracle: same column names, same types, same rows.
"""

from __future__ import annotations

from ..sources.tables import LINE_ORDER, SIGNED_OFFSET
from .catalog import T_DOCS, T_LOW, TARGET


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Fixed values, stated here again so that the statements stand on their own: the
# term delimiters (and carriage return), and the line ends.
RX = _lit(r"""[ *$&#/\t\n\f\r"'\\,.:;?!\[\](){}<>~_-]+""")
LB = _lit(r"\r\n|\r|\n")
EPS = "1e-9"


def _terms(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), {RX}), lambda x: x <> '')"


def _edges(signed: bool = False) -> str:
    dist = f"l_quantity - {SIGNED_OFFSET}" if signed else "l_quantity"
    return (f"(SELECT * FROM (SELECT CAST(l_partkey AS BIGINT) AS src, "
            f"CAST(lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS BIGINT) AS dst, "
            f"CAST({dist} AS DOUBLE) AS dist FROM lineitem) WHERE dst IS NOT NULL)")


def _sets(tbl: str, id_col: str) -> str:
    """(rid, w): distinct terms per row."""
    return (f"(SELECT DISTINCT CAST({id_col} AS BIGINT) AS rid, w FROM "
            f"(SELECT {id_col}, unnest({_terms('text')}) AS w FROM {tbl}))")


def _pairs_per_line(tbl: str) -> str:
    return f"""
    WITH l AS (SELECT unnest(string_split_regex(text, {LB})) AS line FROM {tbl}),
    t AS (SELECT row_number() OVER () AS id, {_terms('line')} AS ts FROM l),
    p AS (SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS pos FROM t),
    pairs AS (SELECT a.w AS term1, b.w AS term2, CAST(count(*) AS BIGINT) AS n
              FROM p a JOIN p b ON a.id = b.id AND a.pos < b.pos GROUP BY 1, 2)"""


def _jaccard(tbl: str, id_col: str, t: float) -> str:
    return f"""
    WITH s AS {_sets(tbl, id_col)},
    n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
    o AS (SELECT a.rid AS i, b.rid AS j, count(*) AS o
          FROM s a JOIN s b ON a.w = b.w AND a.rid < b.rid GROUP BY 1, 2),
    r AS (SELECT i AS id1, j AS id2, CAST(o AS DOUBLE) / CAST(x.n + y.n - o AS DOUBLE) AS sim
          FROM o JOIN n x ON x.rid = i JOIN n y ON y.rid = j)
    SELECT id1, id2, sim FROM r WHERE sim >= {t}"""


def _prefix(tbl: str, id_col: str, t: float) -> str:
    return f"""
    WITH s AS {_sets(tbl, id_col)},
    n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
    f AS (SELECT w, count(*) AS freq FROM s GROUP BY 1),
    r AS (SELECT s.rid, n.n, s.w, row_number() OVER (PARTITION BY s.rid ORDER BY f.freq, s.w) AS pos
          FROM s JOIN f USING (w) JOIN n USING (rid)),
    pre AS (SELECT rid, CAST(n AS INTEGER) AS n, CAST(pos AS INTEGER) AS pos, w AS token FROM r
            WHERE pos <= n - CAST(ceil(n * {t} - {EPS}) AS BIGINT) + 1)"""


def _shortest(with_path: bool) -> str:
    path_cols = ", p.path" if with_path else ""
    return f"""
    WITH RECURSIVE e AS MATERIALIZED (
       SELECT src, dst, CAST(min(dist) AS BIGINT) * 1048576 + 1 AS w FROM {_edges()} GROUP BY 1, 2),
     d(node, cost) USING KEY (node) AS (
       SELECT DISTINCT dst, CAST(0 AS BIGINT) FROM e WHERE dst = {TARGET}
       UNION
       SELECT e.src, CAST(min(d.cost + e.w) AS BIGINT)
       FROM d JOIN e ON e.dst = d.node LEFT JOIN recurring.d r ON r.node = e.src
       WHERE r.cost IS NULL OR d.cost + e.w < r.cost GROUP BY e.src),
     nx AS MATERIALIZED (
       SELECT e.src AS node, min(e.dst) AS nxt
       FROM d JOIN e ON e.src = d.node JOIN d d2 ON d2.node = e.dst
       WHERE d.cost = d2.cost + e.w AND d.node <> {TARGET} GROUP BY 1),
     p(node, path) AS (
       SELECT node, CAST(node AS VARCHAR) FROM d WHERE node = {TARGET}
       UNION ALL
       SELECT nx.node, CAST(nx.node AS VARCHAR) || '->' || p.path FROM nx JOIN p ON nx.nxt = p.node)
    SELECT p.node, CAST(d.cost // 1048576 AS DOUBLE) AS dist,
           CAST(d.cost % 1048576 AS INTEGER) AS hops{path_cols}
    FROM p JOIN d USING (node)"""


_PAIRS_PER_ITEM = f"""
    WITH t AS (SELECT row_number() OVER () AS id, {_terms('text')} AS ts FROM benchmark),
    p AS (SELECT id, unnest(ts) AS w, generate_subscripts(ts, 1) AS pos FROM t)
    SELECT a.w AS term1, b.w AS term2, CAST(count(*) AS BIGINT) AS n
    FROM p a JOIN p b ON a.id = b.id AND a.pos < b.pos GROUP BY 1, 2"""

ORACLE_SQL: dict[str, str] = {
    "terms_benchmark": f"""
    WITH l AS (SELECT item_id, unnest(string_split_regex(text, {LB})) AS line,
                      generate_subscripts(string_split_regex(text, {LB}), 1) - 1 AS line_no
               FROM benchmark),
    t AS (SELECT item_id, line_no, {_terms('line')} AS ts FROM l)
    SELECT item_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos - 1 AS INTEGER) AS pos, term
    FROM (SELECT item_id, line_no, unnest(ts) AS term, generate_subscripts(ts, 1) AS pos FROM t)""",

    "word_count": f"""
    SELECT term, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT unnest({_terms('text')}) AS term FROM documents) GROUP BY term""",

    "cooccurrence_pairs": _pairs_per_line("conversations") + """
    SELECT term1, term2, n FROM pairs""",

    "cooccurrence_documents": _pairs_per_line("documents") + """
    SELECT term1, term2, n FROM pairs""",

    "cooccurrence_rows": _PAIRS_PER_ITEM,

    "cooccurrence_stripes": _pairs_per_line("conversations") + """
    SELECT term1, CAST(count(*) AS INTEGER) AS n_terms, CAST(sum(n) AS BIGINT) AS n_total
    FROM pairs GROUP BY term1""",

    "cooccurrence_stripes_flat": _PAIRS_PER_ITEM,
    "cooccurrence_stripes_merged": _pairs_per_line("conversations") + """
    SELECT term1, term2, n FROM pairs""",
    "cooccurrence_lines": f"""
    SELECT term1 || ' ' || term2 || chr(9) || CAST(n AS VARCHAR) AS line FROM ({_PAIRS_PER_ITEM})""",
    "word_count_lines": f"""
    SELECT term || chr(9) || CAST(count(*) AS VARCHAR) AS line
    FROM (SELECT unnest({_terms('text')}) AS term FROM documents) GROUP BY term""",
    "path_lines": f"""
    SELECT CAST(node AS VARCHAR) || chr(9) || CAST(dist AS VARCHAR) || chr(9) || path AS line FROM ({_shortest(True)})""",
    "edges_from_lines": """
    SELECT l_partkey AS src, l_suppkey AS dst, count(*) AS n, min(l_quantity) AS dist FROM lineitem GROUP BY 1, 2""",
    "sets_from_lines": """
    SELECT DISTINCT o_custkey AS rid, o_orderkey AS token FROM orders""",

    "word_count_files": f"""
    SELECT term, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT unnest({_terms('text')}) AS term FROM documents) GROUP BY term""",
    "word_count_sorted": f"""
    SELECT row_number() OVER (ORDER BY term) - 1 AS line_no, term || chr(9) || CAST(count(*) AS VARCHAR) AS line
    FROM (SELECT unnest({_terms('text')}) AS term FROM documents) GROUP BY term""",
    "path_lines_sorted": f"""
    SELECT row_number() OVER (ORDER BY node) - 1 AS line_no,
           CAST(node AS VARCHAR) || chr(9) || CAST(dist AS VARCHAR) || chr(9) || path AS line FROM ({_shortest(True)})""",
    "pair_lines_sorted": f"""
    SELECT row_number() OVER (ORDER BY id1, id2) - 1 AS line_no,
           '(' || CAST(id1 AS VARCHAR) || ',' || CAST(id2 AS VARCHAR) || ')' || chr(9) || CAST(sim AS VARCHAR) AS line
    FROM ({_jaccard('benchmark', 'item_id', T_LOW)})""",
    "edge_rejects": """
    WITH f AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'none' ELSE CAST(l_partkey AS VARCHAR) END AS src,
                      CASE WHEN l_partkey % 89 = 0 THEN 'far' ELSE CAST(l_quantity AS VARCHAR) END AS dist, * FROM lineitem),
    l AS (SELECT CASE WHEN l_suppkey % 83 = 0 THEN 'fields' WHEN src = 'none' THEN 'src' WHEN dist = 'far' THEN 'dist' ELSE 'good' END AS reason,
                 CASE WHEN l_suppkey % 83 = 0 THEN '' ELSE ' ' || dist END AS tail, * FROM f)
    SELECT reason, CASE WHEN reason = 'good' THEN src || ' ' || CAST(l_suppkey AS VARCHAR)
                   ELSE CAST(l_orderkey AS VARCHAR) || ' ' || src || ' ' || CAST(l_suppkey AS VARCHAR) || tail END AS line, count(*) AS n
    FROM l GROUP BY 1, 2""",
    "set_rejects": """
    WITH c AS (SELECT o_custkey AS c, count(DISTINCT o_orderkey) AS n,
                      array_to_string(list_sort(list(DISTINCT o_orderkey)), ' ') AS ks FROM orders GROUP BY 1),
    l AS (SELECT CASE WHEN c % 37 = 0 THEN 'blank' WHEN c % 31 = 0 THEN 'rid' WHEN c % 29 = 0 THEN 'tokens' ELSE 'good' END AS reason, * FROM c)
    SELECT reason, CASE reason WHEN 'good' THEN CAST(c AS VARCHAR) WHEN 'blank' THEN '  '
                   ELSE CASE WHEN reason = 'rid' THEN 'c' ELSE '' END || CAST(c AS VARCHAR) || ' ' || ks
                        || CASE WHEN c % 29 = 0 THEN ' x' ELSE ' ' END END AS line,
           CAST(CASE WHEN reason = 'good' THEN min(n) ELSE count(*) END AS BIGINT) AS n FROM l GROUP BY reason, 2""",

    "incoming_edge_avg": f"""
    SELECT dst AS node, avg(dist) AS avg_dist FROM {_edges()} GROUP BY dst""",

    "incoming_edge_avg_signed_truncated": f"""
    SELECT * FROM (SELECT dst AS node, avg(dist) AS avg_dist FROM {_edges(True)} GROUP BY dst)
    WHERE abs(avg_dist) >= 1 AND NOT isnan(avg_dist)""",

    "reverse_adjacency": f"""
    WITH m AS (SELECT src, dst, min(dist) AS dist FROM {_edges()} GROUP BY 1, 2),
    c AS (SELECT *, (row_number() OVER (ORDER BY dst, src) - 1) // 4096 AS cut FROM m),
    p AS (SELECT *, count(*) OVER (PARTITION BY dst) AS in_degree, cut - min(cut) OVER (PARTITION BY dst) AS part FROM c)
    SELECT dst AS node, CAST(part AS BIGINT) AS part, CAST(in_degree AS BIGINT) AS in_degree,
           string_agg(CAST(src AS VARCHAR) || ':' || CAST(CAST(dist AS BIGINT) AS VARCHAR), ',' ORDER BY src)
             AS in_edges
    FROM p GROUP BY 1, 2, 3""",

    "shortest_dist": _shortest(False),
    "shortest_paths": _shortest(True),

    "token_ranks": f"""
    WITH s AS {_sets('documents', 'doc_id')},
    f AS (SELECT w AS token, count(*) AS freq FROM s GROUP BY 1)
    SELECT token, freq, CAST(row_number() OVER (ORDER BY freq, token) - 1 AS BIGINT) AS rank FROM f""",

    "prefix_tokens": _prefix("documents", "doc_id", T_DOCS) + """
    SELECT rid, n, pos, token FROM pre""",

    "similarity_candidates": _prefix("documents", "doc_id", T_DOCS) + f"""
    SELECT DISTINCT a.rid AS id1, b.rid AS id2 FROM pre a JOIN pre b
      ON a.token = b.token AND a.rid < b.rid
     AND b.n >= ceil(a.n * {T_DOCS} - {EPS}) AND a.n >= ceil(b.n * {T_DOCS} - {EPS})""",

    "set_similarity_join": _jaccard("documents", "doc_id", T_DOCS),
    "set_similarity_join_given_order": _jaccard("documents", "doc_id", T_DOCS),
    "set_similarity_join_positional": _jaccard("documents", "doc_id", T_DOCS),
    "set_similarity_low": _jaccard("benchmark", "item_id", T_LOW),
    "pair_lines": f"""
    SELECT '(' || CAST(id1 AS VARCHAR) || ',' || CAST(id2 AS VARCHAR) || ')' || chr(9) || CAST(sim AS VARCHAR)
      AS line FROM ({_jaccard('benchmark', 'item_id', T_LOW)})""",
}
