"""Ordered pairs of terms, counted in cells over compressed contexts.

Contexts are packed into blocks of a few million characters: numbers of a block's own
dictionary, most frequent first, compressed.  Copies of a context are found by two hashes
and keep one place, with their number as weight.  Terms get ids by frequency and fall into
``side`` classes; a cell has two classes and gets the terms of both, of contexts that have
both, in their order.  It counts the pairs of both directions, so every term of a
context travels ``side`` times, as one or two bytes, and pairs are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import compact_checkpoint, reliable_checkpoint, share_package
from .cells import MOST_PARTITIONS, _spread
from .ranking import dense_index

# Bytes of text that make a block full; a longer context is a block of its own.
BLOCK_BYTES = 1 << 23

# Bits of a context's place in its block, and of a block's number in its task.
_PLACE_BITS, _BLOCK_BITS = 23, 20

# Terms of a cell, repeats counted, beyond which classes are made smaller; first terms
# that are put in order at once, and pairs that are.
CELL_TERMS = 32_000_000
FIRSTS = 1 << 21
PART = 1 << 20

# Terms in a piece of the vocabulary, and bytes of text in a batch of results.
PIECE = 1 << 16
OUT_BYTES = 1 << 25


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def pack(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes, compressed by place of the byte."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _codec().compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(_codec().decompress(data, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows of a task with two terms or more, in runs whose texts fill a block."""
    held, size = [], 0
    for batch in batches:
        batch = batch.filter(pc.match_substring(batch.column("line"), " "))
        ends, at = np.cumsum(pc.binary_length(batch.column("line")).to_numpy(zero_copy_only=False)), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BLOCK_BYTES - size, side="right")))
            if held and ends[to - 1] - before > BLOCK_BYTES - size:   # a long one starts a block
                yield held
                held, size = [], 0
                continue
            held.append(batch.slice(at, to - at))
            size, at = size + int(ends[to - 1]) - before, to
            if size >= BLOCK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _block(number: int, rows: pa.Table) -> dict:
    """A block of contexts: its dictionary, and the contexts in numbers of it."""
    h1, h2 = (rows.column(c).to_numpy() for c in ("h1", "h2"))
    order = np.lexsort((h2, h1))
    first = np.flatnonzero((np.diff(h1[order], prepend=~h1[order[:1]]) != 0) | (np.diff(h2[order], prepend=~h2[order[:1]]) != 0))
    some = order[first]
    lists = pc.split_pattern(rows.column("line").combine_chunks().take(pa.array(some)), " ")
    coded = lists.flatten().dictionary_encode()
    size = pc.list_value_length(lists).to_numpy().astype(np.int64)
    code, n = coded.indices.to_numpy(), np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
    frequent = np.argsort(-n, kind="stable")
    rank = np.empty_like(frequent)
    rank[frequent] = np.arange(len(frequent))
    return {"block": number, "terms": coded.dictionary.take(pa.array(frequent)).to_pylist(), "counts": n[frequent],
            "h1": h1[some], "h2": h2[some], "w": np.diff(np.append(first, len(order))),
            "n": len(code), "pairs": int((size * (size - 1) // 2).sum()), "sizes": pack(size), "codes": pack(rank[code])}


_BLOCK = pa.schema([("block", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("h1", pa.list_(pa.int64())),
                    ("h2", pa.list_(pa.int64())), ("w", pa.list_(pa.int64())), ("n", pa.int64()), ("pairs", pa.int64()),
                    ("sizes", pa.binary()), ("codes", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << _BLOCK_BITS
    for k, held in enumerate(_slices(batches)):
        block = _block(task + k, pa.Table.from_batches(held))
        yield pa.RecordBatch.from_arrays([pa.array([block[f.name]], f.type) for f in _BLOCK], schema=_BLOCK)


_CELL = pa.schema([("r", pa.int32()), ("c", pa.int32()), ("kind", pa.int32()), ("piece", pa.int64()), ("text", pa.string()), ("places", pa.list_(pa.int64())),
                   ("rows", pa.int64()), ("n", pa.int64()), ("sizes", pa.binary()), ("codes", pa.binary()), ("w", pa.binary())])


def _dealer(side: int) -> Callable:
    """Blocks to cells: the terms of the cell's two classes, of contexts that have a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c: batch.column(c)[row]
                values = lambda c: cell(c).values.to_numpy(zero_copy_only=False)
                yield from deal(cell("block").as_py(), values("ids"), values("places"), values("weights"),
                                cell("n").as_py(), cell("rows").as_py(), cell("sizes").as_py(), cell("codes").as_py())

    def deal(block, ids, places, weights, n, rows, sizes, codes) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(rows, np.int64)
        weight[places] = weights
        size = unpack(sizes, rows).astype(np.int64)
        keep = np.repeat(weight > 0, size)
        line = np.repeat(np.arange(rows, dtype=np.int32), size)[keep]
        ids = ids[unpack(codes, n)[keep]]
        kind, number = (ids % side).astype(np.int32), (ids // side).astype(np.uint32)
        own = [np.flatnonzero(kind == k) for k in range(side)]
        for r in range(side):
            for c in range(r, side):
                at = own[r] if r == c else np.sort(np.concatenate([own[r], own[c]]), kind="stable")
                if len(at) < 2:
                    continue
                of = line[at]
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                k = np.diff(np.append(starts, len(at)))
                second = kind[at] == c
                some = np.add.reduceat(second, starts, dtype=np.int64)
                ok = k >= 2 if r == c else (some > 0) & (some < k)
                if not ok.any():
                    continue
                inside = np.repeat(ok, k)
                code = number[at[inside]] if r == c else number[at[inside]] * 2 + second[inside]
                w = weight[of[starts[ok]]]
                low = pack(w & 0xFFFFFFFF)
                values = [[r], [c], [2], [block], [None], [None], [int(ok.sum())], [len(code)], [pack(k[ok])], [pack(code)],
                          [b"" if w.max() == 1 else len(low).to_bytes(8, "little") + low + pack(w >> 32)]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _CELL)], schema=_CELL)

    return run


class _Cell:
    """Terms of two classes and their contexts, of one cell."""

    def __init__(self):
        self.text = {0: [], 1: []}
        self.places = {0: [], 1: []}
        self.blocks: list[tuple] = []

    def add(self, batch: pa.RecordBatch, row: int) -> None:
        kind, *rest = (batch.column(c)[row].as_py() for c in ("kind", "text", "rows", "n", "sizes", "codes", "w"))
        if kind < 2:
            self.text[kind].append(rest[0])
            self.places[kind].append(batch.column("places")[row].values)
        else:
            self.blocks.append(tuple(rest[1:]))

    def terms(self, kind: int) -> pa.Array:
        """The terms of a class, by number."""
        parts = [pc.split_pattern(pa.array([t], pa.large_string()), " ").flatten() for t in self.text[kind]]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.large_string())

    def _weights(self, w: bytes, rows: int) -> np.ndarray:
        if not w:
            return np.ones(rows, np.int64)
        low = int.from_bytes(w[:8], "little")
        return unpack(w[8:8 + low], rows).astype(np.int64) | (unpack(w[8 + low:], rows).astype(np.int64) << 32)

    def follow(self, same: bool, flip: bool) -> tuple[np.ndarray, ...]:
        """``first, start, count, weight, seconds``: for every first term with later second
        terms its number, their run in ``seconds``, and its context's weight or None."""
        # the largest arrays of a cell: 16 bytes a first term
        total = sum(b[1] for b in self.blocks)
        first, start, count, seconds = (np.empty(total, np.uint32) for _ in range(4))
        weight = np.empty(total, np.int64) if any(b[4] for b in self.blocks) else None
        a = b = 0
        for rows, n, sizes, codes, w in self.blocks:
            size, code = unpack(sizes, rows).astype(np.int64), unpack(codes, n)
            ends = np.cumsum(size)
            if same:
                number, at, later = code, np.arange(n), np.arange(1, n + 1)
                after, end = code, np.repeat(ends, size)
            else:
                second = (code & 1).astype(bool) ^ flip
                number, at = code >> 1, np.flatnonzero(~second)
                run = np.cumsum(second)
                after, later, end = number[second], run[at], np.repeat(run[ends - 1], size)[at]
            k = end - later
            ok = k > 0
            m = int(ok.sum())
            first[a:a + m], start[a:a + m], count[a:a + m] = number[at[ok]], later[ok] + b, k[ok]
            if weight is not None:
                weight[a:a + m] = np.repeat(self._weights(w, rows), size)[at[ok]]
            seconds[b:b + len(after)] = after
            a, b = a + m, b + len(after)
        return first[:a], start[:a], count[:a], None if weight is None else weight[:a], seconds[:b]


def _ordered(first, start, count, weight) -> Iterator[tuple[np.ndarray, ...]]:
    """The first terms in order, by ranges of numbers with ``FIRSTS`` terms or one number."""
    if not len(first):
        return
    for s in _runs(np.bincount(first), FIRSTS):
        at = np.flatnonzero((first >= s.start) & (first < s.stop))
        order = (first[at].astype(np.int64) << 32) | at
        order.sort()
        at = order & 0xFFFFFFFF
        yield (order >> 32).astype(np.uint32), start[at], count[at], None if weight is None else weight[at]


def _counted(first, start, count, weight, seconds, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``first, second, n`` of the pairs, in their order, part by part; seconds are below ``width``."""
    for rows in _ordered(first, start, count, weight):
        if len(rows[0]):
            yield from _counted_in_order(*rows, seconds, width)


def _counted_in_order(first, start, count, weight, seconds, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    begins = np.flatnonzero(np.diff(first.astype(np.int64), prepend=-1))
    reach = np.cumsum(np.add.reduceat(count, begins, dtype=np.int64))
    begins, at = np.append(begins, len(first)), 0
    while at < len(reach):
        before = int(reach[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(reach, before + PART, side="right")))
        rows = slice(begins[at], begins[to])
        if to == at + 1 and reach[at] - before >= width:
            # a frequent first term: its second terms are counted in place
            n = np.zeros(width, np.int64)
            ends, a = np.cumsum(count[rows], dtype=np.int64), 0
            while a < len(ends):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PART, side="right")))
                part = slice(rows.start + a, rows.start + b)
                k = count[part].astype(np.int64)
                met = seconds[_spread(start[part].astype(np.int64), k)]
                if weight is None:
                    n += np.bincount(met, minlength=width)
                else:   # sums of whole numbers below 2^53 are exact
                    n += np.bincount(met, weights=np.repeat(weight[part], k), minlength=width).astype(np.int64)
                a = b
            second = np.flatnonzero(n)
            yield np.full(len(second), first[rows.start], np.int64), second, n[second]
        else:
            k, low = count[rows].astype(np.int64), int(first[rows.start])
            code = np.repeat((first[rows].astype(np.int64) - low) * width, k)
            code += seconds[_spread(start[rows].astype(np.int64), k)]
            if weight is None or (w := weight[rows]).max() == 1:
                code.sort()
                some = np.flatnonzero(np.diff(code, prepend=-1))
                n = np.diff(np.append(some, len(code)))
            else:
                order = np.argsort(code, kind="stable")
                code = code[order]
                some = np.flatnonzero(np.diff(code, prepend=-1))
                n = np.add.reduceat(np.repeat(w, k)[order], some)
            yield code[some] // width + low, code[some] % width, n
        at = to


def _runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows whose sizes add up to ``most``, or single rows that are larger."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield slice(at, to)
        at = to


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, _Cell]]:
    """The cells of a task, whose rows come one after the other, and whether the classes are one."""
    last, cell = None, None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("r", "c"))))
        for row, key in enumerate(keys):
            if key != last:
                if cell is not None and cell.blocks:
                    yield last[0] == last[1], cell
                last, cell = key, _Cell()
            cell.add(batch, row)
    if cell is not None and cell.blocks:
        yield last[0] == last[1], cell


def _directions(same: bool, cell: _Cell) -> Iterator[tuple]:
    """First and second terms, their kinds, and the arrays of :meth:`_Cell.follow`."""
    terms = [cell.terms(0)]
    terms.append(terms[0] if same else cell.terms(1))
    for flip in (False,) if same else (False, True):
        a, b = (1, 0) if flip else (0, 0 if same else 1)
        yield terms[a], terms[b], a, b, cell.follow(same, flip)


def _lengths(terms: pa.Array) -> np.ndarray:
    return pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int64) + 16


_PAIR = pa.schema([("term1", pa.string()), ("term2", pa.string()), ("n", pa.int64())])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for same, cell in _cells(batches):
        for one, two, _, _, follow in _directions(same, cell):
            len1, len2 = _lengths(one), _lengths(two)
            for first, second, n in _counted(*follow, max(1, len(two))):
                for s in _runs(len1[first] + len2[second], OUT_BYTES):
                    yield pa.RecordBatch.from_arrays([one.take(pa.array(first[s])).cast(pa.string()), two.take(pa.array(second[s])).cast(pa.string()),
                                                      pa.array(n[s])], schema=_PAIR)


_LIST = pa.schema([("term1", pa.string()), ("m", pa.int64()), ("places", pa.list_(pa.int64())), ("keys", pa.string()), ("ns", pa.list_(pa.int64()))])


def _joined(terms: pa.ListArray) -> pa.Array:
    """Lists of terms as texts: an array of short strings takes four times the bytes."""
    return pc.binary_join(terms, " ")


def _count_lists(most: int) -> Callable:
    """A cell's pairs as lists of second terms in byte order, at most ``most`` in a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, cell in _cells(batches):
            for one, two, _, kind, follow in _directions(same, cell):
                place = pa.concat_arrays(cell.places[kind]).to_numpy()
                order = np.argsort(place, kind="stable")
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order))
                two, place = two.take(pa.array(order)), place[order]
                len2 = _lengths(two)
                for first, second, n in _counted(*follow[:-1], rank[follow[-1]], len(two)):
                    begins = np.flatnonzero(np.diff(first, prepend=-1))
                    # lists of at most so many entries, in batches of so many bytes
                    k = np.diff(np.append(begins, len(first)))
                    cuts = -(-k // most)
                    begins = np.repeat(begins, cuts) + _spread(np.zeros(len(cuts), np.int64), cuts) * most
                    ends = np.append(begins, len(first))
                    for s in _runs(np.add.reduceat(len2[second], begins), OUT_BYTES):
                        a, b = ends[s.start], ends[s.stop]
                        offsets = pa.array((ends[s.start:s.stop + 1] - a).astype(np.int32))
                        lists = lambda x: pa.ListArray.from_arrays(offsets, x)
                        yield pa.RecordBatch.from_arrays([
                            one.take(pa.array(first[begins[s]])).cast(pa.string()), pa.array(np.diff(ends[s.start:s.stop + 1])), lists(pa.array(place[second[a:b]])),
                            _joined(lists(two.take(pa.array(second[a:b])).cast(pa.string()))), lists(pa.array(n[a:b]))], schema=_LIST)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists cut before the places of ``cuts``: ``term1, part, keys, ns``."""
    for batch in batches:
        for row in range(batch.num_rows):
            places, ns, cuts = (batch.column(c)[row].values for c in ("places", "ns", "cuts"))
            keys = pc.split_pattern(batch.column("keys").slice(row, 1), " ").flatten()
            part = np.searchsorted(cuts.to_numpy(), places.to_numpy(), side="right")
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            offsets = pa.array(np.append(begins, len(part)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column("term1")[row].as_py()] * len(begins), pa.string()), pa.array(part[begins].astype(np.int64)),
                _joined(pa.ListArray.from_arrays(offsets, keys)), pa.ListArray.from_arrays(offsets, ns)], names=["term1", "part", "keys", "ns"])


def pack_contexts(contexts: DataFrame) -> DataFrame:
    """Blocks of ``contexts (terms ARRAY<STRING>)``, written once."""
    share_package(contexts.sparkSession)
    # a term holds no space: the tokenizer cuts there
    line = contexts.select(F.array_join("terms", " ").alias("line")).select(
        "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))
    return reliable_checkpoint(line.mapInArrow(_blocks, "block long, terms array<string>, counts array<long>, h1 array<long>, h2 array<long>, "
                                                        "w array<long>, n long, pairs long, sizes binary, codes binary"))


def vocabulary(blocks: DataFrame) -> DataFrame:
    """``term, id``: ids are dense, frequent terms first."""
    counts = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("e")).groupBy(F.col("e.terms").alias("term")).agg(F.sum("e.counts").alias("freq"))
    return reliable_checkpoint(dense_index(counts, F.col("freq").desc(), "term", name="id").select("term", "id"))


def _sides(blocks: DataFrame, cell_pairs: int) -> int:
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = blocks.agg(F.sum("n").alias("n"), F.sum(F.col("pairs").cast("double")).alias("pairs")).first()
    return max(math.ceil(math.sqrt(parts)), math.ceil(2 * (total["n"] or 0) / CELL_TERMS), math.ceil(math.sqrt((total["pairs"] or 0) / cell_pairs)))


def cells_of(blocks: DataFrame, vocab: DataFrame, cell_pairs: int) -> DataFrame:
    """The rows of the cells, dealt to tasks: pieces of the vocabulary, with ``place`` if it
    has that, then contexts by block."""
    place = F.col("place") if "place" in vocab.columns else F.lit(None).cast("long")
    side = _sides(blocks, cell_pairs)
    # where a context stands first, and how often it stands anywhere
    line = blocks.select("block", F.posexplode(F.arrays_zip("h1", "h2", "w")).alias("place", "e"))
    at = F.shiftleft("block", _PLACE_BITS).bitwiseOR(F.col("place").cast("long"))
    kept = line.groupBy("e.h1", "e.h2").agg(F.min(at).alias("at"), F.sum("e.w").alias("w"))
    kept = kept.groupBy(F.shiftright("at", _PLACE_BITS).alias("block")).agg(
        F.collect_list(F.struct(F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place"), "w")).alias("kept"))
    numbers = blocks.select("block", F.posexplode("terms").alias("pos", "term")).join(vocab, "term").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("ids"))
    rows = blocks.select("block", "n", F.size("h1").cast("long").alias("rows"), "sizes", "codes").join(numbers, "block").join(kept, "block").select(
        "block", "n", "rows", "sizes", "codes", F.transform("ids", lambda x: x["id"]).alias("ids"),
        F.transform("kept", lambda x: x["place"]).alias("places"), F.transform("kept", lambda x: x["w"]).alias("weights"))
    dealt = rows.mapInArrow(_dealer(side), "r int, c int, kind int, piece long, text string, places array<long>, rows long, n long, sizes binary, codes binary, w binary")
    own, number = F.pmod("id", F.lit(side)).cast("int"), F.floor(F.col("id") / side).cast("long")
    pieces = vocab.select(own.alias("own"), number.alias("number"), "term", place.alias("place")).groupBy("own", F.floor(F.col("number") / PIECE).cast("long").alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("number", "term", "place"))).alias("e"))
    goes = F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda o: F.struct(
        F.least("own", o).alias("r"), F.greatest("own", o).alias("c"), F.when(F.col("own") <= o, 0).otherwise(1).alias("kind")))
    pieces = pieces.select("piece", F.array_join(F.transform("e", lambda x: x["term"]), " ").alias("text"), F.transform("e", lambda x: x["place"]).alias("places"),
                           F.explode(goes).alias("g")).select("g.r", "g.c", "g.kind", "piece", "text", "places", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("rows", "long"), ("n", "long"), ("sizes", "binary"), ("codes", "binary"), ("w", "binary"))))
    parts = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * side * (side + 1), MOST_PARTITIONS))
    return pieces.unionByName(dealt).repartition(parts, "r", "c").sortWithinPartitions("r", "c", "kind", "piece")


def count_pairs(contexts: DataFrame, cell_pairs: int) -> DataFrame:
    """``term1, term2, n`` of ``contexts (terms ARRAY<STRING>)``; a cell has about
    ``cell_pairs`` pairs of a direction at most, repeats counted."""
    blocks = pack_contexts(contexts)
    return cells_of(blocks, vocabulary(blocks), cell_pairs).mapInArrow(_count_pairs, "term1 string, term2 string, n long")


# Entries of the table of cuts up to which it is sent to all tasks.
BROADCAST_CUTS = 1 << 20


def count_stripes(contexts: DataFrame, cell_pairs: int, row_limit: int) -> DataFrame:
    """``term1, part, stripe MAP<STRING,LONG>``: the pairs by first term, second terms in byte
    order, ``row_limit`` of them in every row but a term's last.

    A cell gives the lists of its first terms, written once.  Only terms with more than
    ``row_limit`` second terms are cut, by the places of their second terms: whole
    numbers that are gathered without the terms.  Then every list is shuffled once.
    """
    blocks = pack_contexts(contexts)
    vocab = vocabulary(blocks)
    vocab = reliable_checkpoint(dense_index(vocab, "term", name="place"))
    lists = compact_checkpoint(cells_of(blocks, vocab, cell_pairs).mapInArrow(
        _count_lists(row_limit), "term1 string, m long, places array<long>, keys string, ns array<long>"))
    hubs = reliable_checkpoint(lists.groupBy("term1").agg(F.sum("m").alias("degree")).where(F.col("degree") > row_limit))
    size = hubs.agg(F.sum(F.col("degree") / row_limit).alias("n")).first()["n"] or 0
    whole = lists.select("term1", F.lit(0).cast("long").alias("part"), "keys", "ns")
    if size:
        here = (lambda t: F.broadcast(t)) if size <= BROADCAST_CUTS else (lambda t: t)
        hubs = hubs.select("term1")
        places = lists.select("term1", "places").join(here(hubs), "term1").groupBy("term1").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("p"))
        cuts = reliable_checkpoint(places.select("term1", F.transform(
            F.sequence(F.lit(row_limit), F.size("p") - 1, F.lit(row_limit)), lambda i: F.get("p", i)).alias("cuts")))
        cut = lists.join(here(cuts), "term1").select("term1", "places", "keys", "ns", "cuts").mapInArrow(
            _cut, "term1 string, part long, keys string, ns array<long>")
        whole = whole.join(here(hubs), "term1", "left_anti").unionByName(cut)
    rows = whole.groupBy("term1", "part").agg(F.collect_list(F.struct("keys", "ns")).alias("c"))
    entries = F.flatten(F.transform("c", lambda x: F.arrays_zip(F.split(x["keys"], " ").alias("k"), x["ns"].alias("n"))))
    return rows.select("term1", "part", F.map_from_entries(F.sort_array(entries)).alias("stripe"))
