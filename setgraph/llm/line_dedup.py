"""Corpus-wide line dedup: exact repeats and lines within one edit, earliest kept.

Built from DataFrame functions only.  Lines are the ``\\n``-separated parts of a
text.  All but the blank ones lose their exact repeats; near matching takes those of
``MIN_CHARS`` characters or more (an edit would turn a short line into another that is
no copy).

Exact repeats meet in one aggregation that keeps the earliest place of each
distinct line.  Near repeats are joined through deletion neighbourhoods: a line
emits hashed keys of itself and of all its variants with one character deleted;
two lines within one insertion, deletion or substitution share a key.  Only
minima are taken within a key, so no group is expanded into pairs, and each line
is verified with ``levenshtein`` against the earliest candidates.

Before the variants, a lossless filter: one edit leaves the first or the second
half of the shorter line untouched, so only lines that share such a half with
another line (a key of side, length and half) emit variants, and only of the
other half.

Texts and variants are kept out of shuffles where no partner can be: a bitmap of the
candidates' documents stands before the join that fetches their lines, one of the
variants that have a witness before the join with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from .common import fresh, key_filter, materialise, may_hold

MIN_CHARS = 24
MAX_EDITS = 1  # the edit bound; variants for two would grow with the square of a line


def _half_keys(line: Column, n: Column) -> list[Column]:
    """Keys of the halves, as a line of the shorter length and as one longer by a character."""
    keys = []
    for shorter in (n, n - 1):
        a = F.floor(shorter / 2).cast("int")
        keys += [F.xxhash64(F.lit("first"), shorter, F.left(line, a)),
                 F.xxhash64(F.lit("second"), shorter, F.right(line, shorter - a))]
    return keys


def _takes_part(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c")) != ""


def _lines(base: DataFrame) -> DataFrame:
    rows = explode_rows(base, F.split("text", "\n"), "line", "doc", "mark", pos="line_no")
    return rows.where(_takes_part(F.col("line")))


def _distinct_lines(base: DataFrame) -> DataFrame:
    """``h1, h2, n, k0..k3, first(doc, line_no, mark)`` per distinct line.  The two
    hashes stand for the line."""
    n = F.length("line")
    rows = _lines(base).select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"), n.alias("n"),
        *[k.alias(f"k{i}") for i, k in enumerate(_half_keys(F.col("line"), n))],
        F.struct("doc", "line_no", "mark").alias("place"))
    return rows.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.first("n").alias("n"), *[F.first(f"k{i}").alias(f"k{i}") for i in range(4)])


def _candidates(base: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h1, h2, first, key, side, shorter, line``: lines that share a half with another."""
    slots = F.array(*[F.struct(F.col(f"k{i}").alias("key"), F.lit(i).cast("byte").alias("slot")) for i in range(4)])
    halves = distinct.select("h1", "h2", F.inline(slots))
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key")
    halves = halves.join(shared, "key", "left_semi").join(distinct.select("h1", "h2", "first", "n"), ["h1", "h2"])
    halves = halves.select("h1", "h2", "first", "key", (F.col("slot") % 2).alias("side"),
                           F.when(F.col("slot") < 2, F.col("n")).otherwise(F.col("n") - 1).alias("shorter"))
    found = materialise(halves.select("*", "first.*"))
    # the lines' texts, by their earliest place
    near = may_hold(base, [F.col("doc"), F.col("mark")], *key_filter(found, "doc", "mark"))
    return found.join(near, found["doc"].eqNullSafe(near["doc"]) & (found["mark"] == near["mark"])).select(
        "h1", "h2", "first", "key", "side", "shorter",
        F.get(F.split("text", "\n"), F.col("line_no")).alias("line"))


def _variants(candidates: DataFrame) -> DataFrame:
    """``variant, role, first, h1, h2``.  Roles: 'u' the undeleted half, 'd' with one
    deletion (of a line longer by one), 's' with one deletion at a known place
    (lines of equal length, for substitutions)."""
    line, m = F.col("line"), F.col("shorter")
    n, a = F.length(line), F.floor(m / 2).cast("int")
    other = F.when(F.col("side") == 0, F.substring(line, a + 1, n)).otherwise(F.left(line, n - (m - a)))
    rows = candidates.select("h1", "h2", "first", "key", other.alias("other"), (n == m).alias("equal"))
    size = F.length("other")
    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    less = lambda i: F.concat(F.left("other", i - 1), F.substring("other", i + 1, size))
    deleted = F.transform(places, lambda i: F.struct(
        F.when(F.col("equal"), F.xxhash64("key", i, less(i))).otherwise(F.xxhash64("key", less(i))).alias("variant"),
        F.when(F.col("equal"), "s").otherwise("d").alias("role")))
    whole = F.array(F.struct(F.xxhash64("key", "other").alias("variant"), F.lit("u").alias("role")))
    return rows.select("h1", "h2", "first", F.inline(F.when(F.col("equal"), F.concat(whole, deleted)).otherwise(deleted)))


def _near_lines(base: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h1, h2`` of the distinct lines within an edit of an earlier one."""
    cand = materialise(_candidates(base, distinct))
    rows = _variants(cand)
    least = lambda role: F.min(F.when(F.col("role") == role, F.struct("first", "h1", "h2")))
    most = F.max(F.when(F.col("role") == "s", F.struct("first", "h1", "h2")))
    groups = rows.groupBy("variant").agg(least("u").alias("u"), least("d").alias("d"), least("s").alias("s"),
                                         (least("s") != most).alias("s_lines"))
    # (a group of one line is of no use: its least line is the line itself)
    groups = materialise(groups.where("(u IS NOT NULL AND d IS NOT NULL) OR (s IS NOT NULL AND s_lines)"))
    rows = may_hold(rows, [F.col("variant")], *key_filter(groups, "variant"))
    # The earliest line at hand for each role: 's' meets 's', 'u' meets 'd' and 'd' meets 'u'.
    witness = F.when(F.col("role") == "s", F.col("s")).when(F.col("role") == "u", F.col("d")).otherwise(F.col("u"))
    pairs = (rows.join(groups, "variant").select("h1", "h2", "first", witness.alias("w"))
             .where(F.col("w.first") < F.col("first")).select("h1", "h2", F.col("w.h1").alias("w1"), F.col("w.h2").alias("w2"))
             .distinct())
    lines = cand.select("h1", "h2", "line").dropDuplicates(["h1", "h2"])
    earlier = lines.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("line").alias("earlier"))
    return (pairs.join(lines, ["h1", "h2"]).join(earlier, ["w1", "w2"])
            .where(F.levenshtein("line", "earlier", MAX_EDITS).between(0, MAX_EDITS))
            .select("h1", "h2").distinct())


def _decisions(base: DataFrame, min_chars: int) -> DataFrame:
    """``doc, mark, kept ARRAY<INT>, near``: line numbers that stay among those that
    take part, and the number of lines dropped as near repeats."""
    distinct = _distinct_lines(base)
    near = materialise(_near_lines(base, distinct.where(F.col("n") >= min_chars))).withColumn("is_near", F.lit(True))
    lines = distinct.join(near, ["h1", "h2"], "left").select("first.*", F.col("is_near").isNotNull().alias("is_near"))
    return lines.groupBy("doc", "mark").agg(
        F.collect_list(F.when(~F.col("is_near"), F.col("line_no"))).alias("kept"),
        F.count(F.when(F.col("is_near"), 1)).alias("near"))


def _rewritten(base: DataFrame, min_chars: int) -> DataFrame:
    """``base`` with ``clean`` (the text without dropped lines), ``n_lines``,
    ``n_dropped`` and ``n_near``."""
    d = _decisions(base, min_chars).select(F.col("doc").alias("d"), F.col("mark").alias("m"), "kept", "near")
    rows = base.join(d, base["doc"].eqNullSafe(d["d"]) & (base["mark"] == d["m"]), "left").drop("d", "m")
    rows = rows.withColumn("lines", F.split("text", "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    partakers = F.filter(every, lambda i: _takes_part(F.get("lines", i)))
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    stay = F.array_except(every, F.array_except(partakers, kept))  # hashed, so linear in the lines
    rows = rows.withColumn("stay", F.when(F.col("text").isNotNull(), stay))
    return rows.select(
        *base.columns,
        F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("clean"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines") - F.size("stay")), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"))


def _base(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc, mark, text[, more]``; ``mark`` tells rows apart that repeat an id."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"), *more)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_exact, n_near, text`` per document.

    Places are ordered by (doc_id, line number), NULL ids first.  A line is
    dropped where an equal line stands at an earlier place (``n_exact``), or, at
    its earliest place, where a different line within one edit has an earlier
    one, kept or not (``n_near``); the latter both of ``min_chars`` characters or more.
    Blank lines stay.  ``text`` is what stays; it is empty where every line went.  NULL text stays NULL with no lines.  Rows that repeat an id
    and text are one document and give equal rows.  Other columns are ignored.
    """
    rows = _rewritten(_base(docs), min_chars)
    return rows.select(F.col("doc").alias("doc_id"), "n_lines", (F.col("n_dropped") - F.col("n_near")).alias("n_exact"),
                       "n_near", F.col("clean").alias("text"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_chars``, where there is one, counted
    anew.  A row that had words and has none left goes: all of it stands elsewhere.
    Rows without words (NULL, empty, blank) stay."""
    row = fresh(docs, "row")
    rows = _rewritten(_base(docs, F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias(row)), min_chars)
    blank = lambda c: F.coalesce(F.btrim(c, F.lit(" \t\n\r\x0b\x0c")) == "", F.lit(True))
    rows = rows.where(blank("text") | ~blank("clean"))
    new = {"text": F.col("clean").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("clean")).otherwise(F.col(row)["n_chars"]).cast(
            docs.schema["n_chars"].dataType)
    return rows.select(*[(new[c] if c in new else F.col(row)[c]).alias(c) for c in docs.columns])
