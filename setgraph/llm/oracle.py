"""DuckDB statements for the registered queries that SQL can express.

They compute the results by plain definitions (strings, joins, recursion), not
by the operators' methods.
"""

from __future__ import annotations

# Words: runs without the six ASCII white-space characters; A-Z lower-cased.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"'[\x20\x09-\x0D]+'"


def _shingles(table: str, key: str) -> str:
    """(key, sh): the distinct five-word shingles of each text; of fewer words, all in one."""
    return f"""
    (SELECT DISTINCT {key}, unnest(CASE
        WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
     FROM (SELECT {key}, list_filter(string_split_regex({_LOWER}, {_SPACE}), lambda x: x <> '') AS ws FROM {table}))"""


_NEAR = f"""
    WITH RECURSIVE s AS MATERIALIZED {_shingles('documents', 'doc_id')},
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    overlap AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
             FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (
        SELECT a, b FROM overlap JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * k >= 75 * (x.n + y.n - k)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
    SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
           least(doc_id, coalesce(least.b, doc_id)) AS component_id,
           doc_id = least(doc_id, coalesce(least.b, doc_id)) AS kept
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = doc_id"""

_LEAKS = f"""
    WITH d AS MATERIALIZED {_shingles('documents', 'doc_id')},
    i AS MATERIALIZED {_shingles('benchmark', 'item_id')},
    n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY 1),
    k AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (sh) GROUP BY 1, 2)
    SELECT doc_id, item_id, CAST(n_shared AS BIGINT) AS n_shared, CAST(n_item AS BIGINT) AS n_item,
           CAST(n_shared AS DOUBLE) / CAST(n_item AS DOUBLE) AS containment
    FROM k JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item"""

# Near repeats are of 24 characters or more; blank lines stay.  One edit leaves the first or the last ten
# characters as they are; candidates are compared character by character.
_LINE_DEDUP = """
    WITH l AS MATERIALIZED (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
    f AS MATERIALIZED (
        SELECT line, length(line) AS n, min(row(doc_id, no)) AS place FROM l
        WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY 1),
    g AS (SELECT * FROM f WHERE n >= 24),
    c AS (SELECT a.line AS a, b.line AS b FROM g a JOIN g b ON left(a.line, 10) = left(b.line, 10)
            AND abs(a.n - b.n) <= 1 AND b.place < a.place
          UNION SELECT a.line, b.line FROM g a JOIN g b ON right(a.line, 10) = right(b.line, 10)
            AND abs(a.n - b.n) <= 1 AND b.place < a.place),
    near AS (
        SELECT DISTINCT a AS line FROM c WHERE CASE
          WHEN length(a) = length(b) THEN
            len(list_filter(list_zip(string_split(a, ''), string_split(b, '')), lambda x: x[1] <> x[2])) = 1
          WHEN length(a) < length(b) THEN
            len(list_filter(range(1, length(b) + 1), lambda i: left(b, i - 1) || substr(b, i + 1) = a)) > 0
          ELSE len(list_filter(range(1, length(a) + 1), lambda i: left(a, i - 1) || substr(a, i + 1) = b)) > 0 END),
    v AS (SELECT l.doc_id, l.no, l.line,
                 f.place IS NOT NULL AND f.place <> row(l.doc_id, l.no) AS exact,
                 f.place IS NOT NULL AND f.place = row(l.doc_id, l.no) AND near.line IS NOT NULL AS near
          FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN near ON l.line = near.line)
    SELECT doc_id, CAST(count(v.no) AS BIGINT) AS n_lines, CAST(count(*) FILTER (v.exact) AS BIGINT) AS n_exact,
           CAST(count(*) FILTER (v.near) AS BIGINT) AS n_near,
           CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE
             coalesce(string_agg(v.line, chr(10) ORDER BY v.no) FILTER (NOT v.exact AND NOT v.near), '') END AS text
    FROM documents d LEFT JOIN v USING (doc_id) GROUP BY doc_id"""

# Every anchor's score with every row, by components.
_HARD_NEGATIVES = """
    WITH q AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                      [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
               FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    r AS (SELECT *, row_number() OVER () AS k FROM q),
    c AS (SELECT k, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM r),
    a AS (SELECT * FROM r WHERE vec_id % 50 = 0),
    o AS (SELECT e.k AS ak, f.k AS k, CAST(sum(e.x * f.x) AS BIGINT) AS s
          FROM c e JOIN a ON a.k = e.k JOIN c f ON f.d = e.d GROUP BY 1, 2),
    s AS (SELECT a.k AS ak, a.vec_id AS anchor_id, b.k, b.vec_id, a.label = b.label AS same, coalesce(o.s, 0) AS s
          FROM a JOIN r b ON a.k <> b.k LEFT JOIN o ON o.ak = a.k AND o.k = b.k),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ak ORDER BY s DESC, vec_id, k) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.s AS positive_score, s.vec_id AS negative_id, s.s AS negative_score,
                 row_number() OVER (PARTITION BY p.ak, p.k ORDER BY s.s DESC, s.vec_id, s.k) AS rank
          FROM p JOIN s ON s.ak = p.ak AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": _LINE_DEDUP,
    "op4_minhash_near_dedup": _NEAR,
    "op5_decontamination": _LEAKS,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
