"""Mixing sources to target weights by balanced sampling (cube method).

Each source has a target number of words.  A source of ``size`` words is taken
``r = target / size`` times: every document ``floor(r)`` times, and once more with
the inclusion probability ``r - floor(r)``.  The sample of these further copies is
balanced on two totals per source, words and documents.

Flight.  Three documents of probabilities strictly between 0 and 1 have a direction
in which both totals stay as they are, the null space of their two constraints.
The probabilities move along it, one way or the other with the odds that keep every
expectation, until one of the documents is in or out; the next document takes its
place.  So a task streams over the documents of its part and holds two of them; few
are left undecided.  A source of many documents is cut into parts of bounded size;
what they leave is the input of the next level, until a source is one part.

Documents come largest first.  A held document that is far larger than those to come
would never be decided, as they cannot outweigh it; it is decided at once (a move along
the null space of the word total alone) and the words that it owes are spread over the
probabilities of all documents of its part still to come.  It is decided by its
probability, unless those could make good only one of the two decisions.

Landing.  The last two documents of a source are decided on the words alone, the very
last by its probability; they are of the smallest.

The random numbers are keyed hashes of the rows, and rows come in a fixed order, so
reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from ..operators.ranking import dense_index, split_lookup
from .common import materialise

WEIGHTS = (5, 2, 1)    # of the sources in code point order, repeating
MOST = 3               # times that a document may be taken
PART = 65_536          # documents of a part
LINGER = 2.0           # a held document so many times as large as the next one is decided
SEED = "mix"
EPS = 1e-9             # a probability so near to 0 or 1 is that


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes (source, source_size, ...)`` with ``place`` and ``target DOUBLE``.

    The targets share the sum of all sizes by weight; one beyond ``most`` times its
    source's size stops there, and its excess is shared by weight among the others,
    until none is above.  Sources take their weights in code point order, NULL last.
    """
    keyed = dense_index(sizes.withColumn("_null", F.col("source").isNull()), "_null", "source", name="place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = materialise(keyed.select(*sizes.columns, "place", weight.cast("long").alias("weight"),
                                     (F.col("source_size") * most).alias("cap")))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    # the words a unit of weight gets; it grows as more sources stop at their caps
    level, share, open_weight = 0.0, 0, 0
    while True:
        below = F.col("weight") * F.lit(level) <= F.col("cap")
        row = table.agg(F.sum(F.when(below, F.col("weight"))).alias("w"), F.sum(F.when(~below, F.col("cap"))).alias("c")).first()
        if not row["w"] or (total - (row["c"] or 0)) / row["w"] <= level:
            break
        share, open_weight = total - (row["c"] or 0), row["w"]
        level = share / open_weight
    wanted = F.col("weight") * F.lit(float(share)) / F.lit(float(max(1, open_weight)))
    return table.select(*sizes.columns, "place", F.least(wanted, F.col("cap").cast("double")).alias("target"))


class Flight:
    """The flight over one part: documents in, documents with their probabilities out."""

    def __init__(self, words: int, last: bool):
        self.rest = float(words)        # words of the documents still to come
        self.last = last                # whether the part is all of its source
        self.debt = 0.0                 # words that decisions have left open
        self.held: list[list] = []      # [probability, size, random number, row]

    @staticmethod
    def _odds(p: list[float], u: list[float]) -> tuple[float, float]:
        """How far the probabilities can move along ``u`` and against it."""
        up = min(((1 - a) / b if b > 0 else -a / b) for a, b in zip(p, u) if b)
        down = min((a / b if b > 0 else (a - 1) / b) for a, b in zip(p, u) if b)
        return up, down

    def _move(self, docs: list[list], u: list[float], random: float) -> None:
        up, down = self._odds([d[0] for d in docs], u)
        step = up if random * (up + down) < down else -down
        for d, b in zip(docs, u):
            d[0] += step * b

    def _out(self) -> Iterator[tuple]:
        held = []
        for d in self.held:
            if EPS < d[0] < 1 - EPS:
                held.append(d)
            else:
                yield d[3], float(round(d[0]))
        self.held = held

    def _settle(self, d: list, to_come: float) -> None:
        """Decide a document by its probability; its words are owed to the total.

        The documents to come can give up no more words than ``to_come`` and take no more
        than the rest of theirs.  Where only one of the decisions can be made good, it is
        taken; but a part leaves the document to the next level, where more follow."""
        give = (1 - d[0]) * d[1] - self.debt <= to_come
        take = d[0] * d[1] + self.debt <= self.rest - to_come
        if self.last or (give and take):
            chosen = (1.0 if d[2] < d[0] else 0.0) if give == take else float(give)
            self.debt += (d[0] - chosen) * d[1]
            d[0] = chosen

    def add(self, probability: float, size: int, random: float, row: object) -> Iterator[tuple]:
        lingering = [d for d in self.held if d[1] > LINGER * size]
        for d in lingering:
            self._settle(d, probability * self.rest)
            self.held.remove(d)
            yield d[3], d[0]
        if self.debt and self.rest > 0:
            # the debt is paid by all documents to come, each by its share of their words
            paid = min(1.0, max(0.0, probability + self.debt / self.rest))
            self.debt -= (paid - probability) * size
            probability = paid
        self.rest -= size
        self.held.append([probability, size, random, row])
        yield from self._out()
        if len(self.held) == 3:
            a, b, c = (d[1] for d in self.held)
            u = [b - c, c - a, a - b] if not a == b == c else [1, -1, 0]
            self._move(self.held, u, random)
            yield from self._out()

    def end(self) -> Iterator[tuple]:
        """What is held: decided if the part is all of its source, else as it is."""
        while self.last and len(self.held) >= 2:
            a, b = self.held[0][1], self.held[1][1]
            self._move(self.held[:2], [b, -a] if a or b else [1, -1], self.held[1][2])
            yield from self._out()
        for d in self.held if self.last else ():
            # what is still owed may tip the last one, as far as its own words go
            if d[1]:
                d[0] = min(1.0, max(0.0, d[0] + self.debt / d[1]))
            d[0] = 1.0 if d[2] < d[0] else 0.0
        yield from self._out()
        yield from ((d[3], d[0]) for d in self.held)


def _fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted parts, the largest documents first, with ``p`` moved: 0 or 1 where
    decided."""
    flight, at = None, None

    def record(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["place", "doc_id", "size", "copy", "p"])

    def close() -> list[tuple]:
        return [(*row, p) for row, p in flight.end()] if flight else []

    for batch in batches:
        cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        out: list[tuple] = []
        for place, part, last, words, p, size, random, doc_id, copy in zip(
                *(cols[c] for c in ("place", "part", "last", "words", "p", "size", "random", "doc_id", "copy"))):
            if at != (place, part):
                out += close()
                flight, at = Flight(words, last), (place, part)
            out += [(*row, q) for row, q in flight.add(p, size, random, (place, doc_id, size, copy))]
        yield record(out)
    yield record(close())


def _level(rows: DataFrame, level: int, part: int) -> DataFrame:
    """One flight over ``place, doc_id, size, copy, p``; sources of one part land."""
    parts = materialise(rows.groupBy("place").agg(F.count(F.lit(1)).alias("rows"))).withColumn("parts", F.ceil(F.col("rows") / F.lit(part)).cast("int"))
    key = F.xxhash64(F.lit(level), F.lit(SEED), "doc_id", "size", "copy")
    cut = split_lookup(rows, parts, "place", "rows").withColumn("part", F.pmod(key, F.col("parts")).cast("long"))
    words = cut.groupBy("place", "part").agg(F.sum("size").alias("words"))
    flown = cut.join(words, ["place", "part"]).select(
        "place", "part", (F.col("parts") == 1).alias("last"), "words", "p", "size",
        (F.pmod(F.xxhash64(F.lit(SEED), F.lit(level), "doc_id", "size", "copy"), F.lit(1 << 52)) / F.lit(float(1 << 52))).alias("random"),
        "doc_id", "copy").repartition("place", "part").sortWithinPartitions("place", "part", F.col("size").desc(), "random", "doc_id", "copy", "p")
    return materialise(flown.mapInArrow(_fly, "place long, doc_id long, size long, copy long, p double"))


def _numbered(rows: DataFrame) -> DataFrame:
    """One row for each of ``n`` equal rows, numbered by ``copy``; the numbers are made in
    two steps, so that no array is longer than a part."""
    stretches = explode_rows(rows, F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(PART)).cast("long")), "stretch", *rows.columns)
    first = F.col("stretch") * PART
    numbers = F.sequence(first, F.least(first + (PART - 1), F.col("n") - 1))
    return explode_rows(stretches, numbers, "copy", *[c for c in rows.columns if c != "n"])


def sample_balanced(rows: DataFrame, part: int = PART) -> DataFrame:
    """``place, doc_id, size, copy, p`` with every ``p`` moved to 0 or 1, balanced on the sums
    of ``size`` and of rows per ``place``."""
    fixed = rows.where((F.col("p") <= EPS) | (F.col("p") >= 1 - EPS)).withColumn("p", F.round("p"))
    open_, level = rows.where((F.col("p") > EPS) & (F.col("p") < 1 - EPS)), 0
    while True:
        flown = _level(open_, level, part << level)     # larger from level to level, so that the last one is reached
        decided = F.col("p").isin(0.0, 1.0)
        fixed = fixed.unionByName(flown.where(decided))
        open_, level = flown.where(~decided), level + 1
        if open_.isEmpty():
            return fixed


def word_number(text: Column) -> Column:
    """Words (runs without ASCII white space) of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, part: int = PART) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, copies`` per document.

    ``size`` is the document's words, ``source_size`` its source's, ``target`` what the mix
    wants of the source, ``copies`` how often it takes the document and ``taken`` the
    words of these, never above ``most * size``.  NULL is a source of its own.  A
    source without words has target 0 and gives nothing; documents without words are
    taken like others of their source.  Repeated rows are sampled one by one; other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       word_number(F.col("text").cast("string")).alias("size"))
    rows = materialise(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"))
    targets = source_targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # NULL by a key of its own, so that the joins are plain ones; a source may hold a third of all rows
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    targets = materialise(targets.select("place", name.alias("name"), "source", "documents", "source_size", "target", rate.alias("rate"),
                                         F.floor(rate).cast("long").alias("whole")))
    odds = targets.select("name", "documents", "place", (F.col("rate") - F.col("whole")).alias("p"))
    placed = split_lookup(rows.withColumn("name", name), odds, "name", "documents")
    units = materialise(_numbered(placed.select("place", "doc_id", "size", "p", "n")).select("place", "doc_id", "size", "copy", "p"))
    out = split_lookup(sample_balanced(units, part), targets, "place", "documents")
    copies = F.col("whole") + F.col("p").cast("long")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("copies"))
