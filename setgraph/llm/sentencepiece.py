"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is encoded by the merges of a SentencePiece BPE model: a space is put in
front, spaces become the space symbol, and among all neighbouring symbols whose
join is a piece the best piece is merged, leftmost first among equals, until
none is left.  A candidate taken from the agenda is skipped, for good, where a
keyed hash says so: of the seed, the text's key, the word's place in the text, the
word, the place in the word and the piece.  The same seed and epoch give the same pieces on
any cluster; other epochs and places give others.  Characters without a piece
become byte pieces, a literal space symbol too, so decoding restores every text.

No piece holds a space symbol after another character, or a line break, so words
with the spaces before them are encoded independently.  Equal words are encoded
once a block without skips, and an occurrence takes that where the keyed hash drops
none of its merges; the others are encoded one by one.  All words of one length go
together: each round every word takes its best candidate.  Words longer than ``LONG`` symbols use a
heap.  A text is cut into blocks at word bounds, so memory is bounded by a block.

The model file is read once on the driver and sent to the tasks; texts in other
tokenizers' files are not trained here or elsewhere.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .common import finish, list_array, map_arrow, texts

DROPOUT = 0.1
SEED = 20240501
LONG = 24             # symbols of a word beyond which the heap is used
BLOCK = 1_000_000     # characters encoded together, but for single words longer than that

SPACE = "▁"
_WORD = re.compile(r" *[^ \n]+| +|\n")
_NONE = np.iinfo(np.int32).max
_G = np.uint64(0x9E3779B97F4A7C15)


def default_model() -> str:
    """Path of the public 32k piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Tables of a model: symbols of characters, merges of symbol pairs, bytes of pieces.

    Symbols are piece numbers; a character without a piece of its own has the
    symbol ``size`` + code point."""

    def __init__(self, model: bytes):
        sp = SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.bytes = [b""] * self.size
        self.byte_piece = [0] * 256
        pieces: dict[str, int] = {}
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_piece[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[piece] = i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("the model has pieces that cross words")
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[ord(" ")] = self.symbol[ord(SPACE)]
        self.symbol[ord(SPACE)] = self.size + ord(SPACE)  # a literal one is no space
        # rank of a piece by its score, equal scores alike
        scores = np.array([sp.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        one = {p: i for p, i in pieces.items() if len(p) > 1}
        part = lambda s: pieces.get(s, self.size + ord(s) if len(s) == 1 else None)
        pairs = {(a, b): i for p, i in one.items() for k in range(1, len(p))
                 if (a := part(p[:k])) is not None and (b := part(p[k:])) is not None}
        self._table(pairs)

    def _table(self, pairs: dict[tuple[int, int], int]) -> None:
        """An open-addressing table of the pairs, at most a quarter full."""
        self.bits = max(4, int(np.ceil(np.log2(4 * max(len(pairs), 1)))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        self.pairs = pairs
        for (a, b), i in pairs.items():
            key = a << 21 | b
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.values[at] = key, i

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _G) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pieces of symbol pairs, -1 where there is none."""
        key = a.astype(np.int64) << 21 | b
        at = self._slot(key)
        out = np.full(key.shape, -1, dtype=np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def rank_of(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece >= 0, self.rank[piece], _NONE)


def _skipped(key: np.ndarray, place: np.ndarray, piece: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Which candidates the keyed hash drops."""
    h = finish(key + place.astype(np.uint64) * _G)
    return finish(h + piece.astype(np.uint64) * _G) < limit


def _short_words(v: Vocabulary, symbols: np.ndarray, key: np.ndarray, limit: np.uint64,
                 took: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge words of one length (rows of ``symbols``).  Yields (rows, symbols) of words
    that are done, their symbols at the places where they start and -1 elsewhere;
    ``took`` gets (rows, places, pieces) of each round's merges.

    A symbol stays at its place and knows its neighbours' (linked lists in two tables), so a
    merge changes three candidates and moves nothing."""
    rows, (w, n) = np.arange(len(symbols)), symbols.shape
    if n == 1:
        yield rows, symbols
        return
    piece = np.full((w, n), -1, dtype=np.int32)     # the candidate at a place: with the next symbol
    piece[:, :-1] = v.merged(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(w, n - 1)
    rank = v.rank_of(piece)
    after = np.broadcast_to(np.arange(1, n + 1), (w, n)).copy()
    before = np.broadcast_to(np.arange(-1, n - 1), (w, n)).copy()
    while len(rows):
        best = rank.argmin(axis=1)
        m = np.flatnonzero(rank[np.arange(len(rows)), best] < _NONE)
        if len(m) <= 0.7 * len(rows):       # the others are done
            done = np.ones(len(rows), dtype=bool)
            done[m] = False
            yield rows[done], symbols[done]
            rows, symbols, piece, rank, after, before, key, best = (x[m] for x in (rows, symbols, piece, rank, after, before, key, best))
            m = np.arange(len(rows))
        b = best[m]
        new = piece[m, b]
        skip = _skipped(key[m], b, new, limit)
        rank[m[skip], b[skip]] = _NONE
        m, b, new = m[~skip], b[~skip], new[~skip]
        if took is not None:
            took.append((rows[m], b, new))
        gone = after[m, b]
        right = after[m, gone]
        symbols[m, b], symbols[m, gone], rank[m, gone] = new, -1, _NONE
        after[m, b] = right
        r, left = np.flatnonzero(right < n), before[m, b]
        before[m[r], right[r]] = b[r]
        pair = np.full(len(m), -1, dtype=np.int32)
        pair[r] = v.merged(new[r], symbols[m[r], right[r]])
        piece[m, b], rank[m, b] = pair, v.rank_of(pair)
        r = np.flatnonzero(left >= 0)
        pair = v.merged(symbols[m[r], left[r]], new[r])
        piece[m[r], left[r]], rank[m[r], left[r]] = pair, v.rank_of(pair)


def _long_word(v: Vocabulary, symbols: np.ndarray, key: np.uint64, limit: np.uint64, took: list | None = None) -> list[int]:
    """The same merges for one word, with a heap and a linked list; ``took`` gets (place, piece) of each."""
    sym: list[int] = symbols.tolist()
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def push(i: int, j: int) -> None:
        piece = v.pairs.get((sym[i], sym[j]))
        if piece is not None:
            heapq.heappush(agenda, (int(v.rank[piece]), i, piece, sym[i], sym[j]))

    for i in range(n - 1):
        push(i, i + 1)
    one = np.array([key], dtype=np.uint64)
    while agenda:
        _, i, piece, a, b = heapq.heappop(agenda)
        j = after[i] if sym[i] == a else n
        if j >= n or sym[j] != b:
            continue  # one of the two has been merged since
        if _skipped(one, np.array([i]), np.array([piece]), limit)[0]:
            continue
        if took is not None:
            took.append((i, piece))
        sym[i], sym[j] = piece, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    return [s for s in sym if s >= 0]


class Encoder:
    """Encoding and decoding with one vocabulary, seed, epoch and rate."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED, epoch: int = 0):
        self.v = vocabulary
        self.limit = np.uint64(min(int(dropout * 2.0 ** 64), 2 ** 64 - 1))
        self.seed = xxhash.xxh3_64_intdigest(f"{seed}:{epoch}".encode())

    def blocks(self, keys: list[int], texts_: list[str | None]) -> Iterator[list[tuple[int, int, int, str]]]:
        """Lists of (text, its key, number of the first word, part of it) of about BLOCK characters."""
        held, size = [], 0
        for i, (key, text) in enumerate(zip(keys, texts_)):
            if not text:
                continue
            body, at, words = " " + text, 0, 0
            while at < len(body):
                end = at + BLOCK
                cut = re.compile(r"(?<=[^ ]) ").search(body, end) if end < len(body) else None
                part = body[at:cut.start() if cut else len(body)]
                held.append((i, key, words, part))
                at, size, words = at + len(part), size + len(part), words + BLOCK
                if size >= BLOCK:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def encode(self, keys: list[int], texts_: list[str | None]) -> list[np.ndarray]:
        """Piece numbers of each text.  ``keys`` are part of the keyed hash."""
        parts: list[list[np.ndarray]] = [[] for _ in texts_]
        for block in self.blocks(keys, texts_):
            for (i, *_), ids in zip(block, self._block(block)):
                parts[i].append(ids)
        return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.empty(0, np.int32) for p in parts]

    def _block(self, block: list[tuple[int, int, int, str]]) -> list[np.ndarray]:
        number: defaultdict[str, int] = defaultdict(count().__next__)
        found = [_WORD.findall(part) for *_, part in block]
        sizes = np.array([len(f) for f in found])
        coded = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=int(sizes.sum()))
        ends = np.cumsum(sizes)
        place = np.arange(len(coded)) - np.repeat(ends - sizes, sizes) + np.repeat([first for _, _, first, _ in block], sizes)
        own = np.repeat(np.array([key & (2 ** 64 - 1) for _, key, _, _ in block], dtype=np.uint64), sizes)
        seed = np.full(1, self.seed, dtype=np.uint64)
        spot = finish(finish(own + seed) + place.astype(np.uint64) * _G)
        words, which = list(number), coded
        ids, size, merges = self._kinds(words, np.arange(len(words)), None)
        if self.limit:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
            key = finish(hashes[coded] + spot)
            skips = np.flatnonzero(self._skips(coded, key, *merges))
            others, lengths, _ = self._kinds(words, coded[skips], key[skips])
            ids, size = np.concatenate([ids, others]), np.concatenate([size, lengths])
            which = coded.copy()
            which[skips] = len(words) + np.arange(len(skips))
        first = np.cumsum(size) - size
        take = size[which]
        stop = np.cumsum(take)
        flat = ids[np.arange(int(take.sum())) + np.repeat(first[which] - (stop - take), take)]
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], ends])]
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def _skips(self, word: np.ndarray, key: np.ndarray, owner: np.ndarray, at: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the keyed hash drops one of the merges that an occurrence's word has without skips."""
        merges = np.bincount(owner, minlength=int(word.max(initial=-1)) + 1)
        begin = np.cumsum(merges) - merges
        out = np.zeros(len(word), dtype=bool)
        todo, k = np.flatnonzero(merges[word] > 0), 0
        while len(todo):  # the k-th merge of all occurrences that have one and no skip yet
            row = begin[word[todo]] + k
            out[todo] = _skipped(key[todo], at[row], piece[row], self.limit)
            k += 1
            todo = todo[~out[todo] & (merges[word[todo]] > k)]
        return out

    def _kinds(self, words: list[str], word: np.ndarray, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, tuple | None]:
        """The pieces of words under their keys, one after the other, and their numbers.
        Without keys nothing is skipped, and the merges come too: (word, place, piece)."""
        v = self.v
        limit, merges = (self.limit, None) if key is not None else (np.uint64(0), [])
        key = np.zeros(len(word), np.uint64) if key is None else key
        symbols = v.symbol[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(length) - length
        owner, values = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for n in np.unique(length[word]).tolist():
            at = np.flatnonzero(length[word] == n)
            table = symbols[first[word[at]][:, None] + np.arange(n)]
            if n > LONG:
                for i, row in zip(at, table):
                    took = None if merges is None else []
                    made = np.array(_long_word(v, row, key[i], limit, took), dtype=np.int32)
                    if took:
                        merges.append((np.full(len(took), i), *np.array(took, dtype=np.int32).T))
                    owner.append(np.full(len(made), i))
                    values.append(made)
                continue
            took = None if merges is None else []
            for rows, made in _short_words(v, table, key[at], limit, took):
                owner.append(np.repeat(at[rows], (made >= 0).sum(axis=1)))
                values.append(made[made >= 0])
            if took:
                merges += [(at[rows], places, pieces) for rows, places, pieces in took]
        if merges is not None:
            who, *what = ([np.concatenate(x) for x in zip(*merges)] if merges else [np.empty(0, np.int64)] * 3)
            order = np.argsort(who, kind="stable")
            merges = (who[order], *(x[order] for x in what))
        owner, values = np.concatenate(owner), np.concatenate(values)
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], values[order]
        unknown = np.flatnonzero(values >= v.size)
        if len(unknown):  # to byte pieces
            as_bytes = [[v.byte_piece[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in (values[unknown] - v.size).tolist()]
            repeat = np.ones(len(values), dtype=np.int64)
            repeat[unknown] = [len(b) for b in as_bytes]
            owner, wide = np.repeat(owner, repeat), np.repeat(values, repeat)
            wide[wide >= v.size] = [b for bs in as_bytes for b in bs]
            values = wide
        return values.astype(np.int32), np.bincount(owner, minlength=len(word)), merges

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece numbers; the space in front is taken off."""
        text = b"".join(map(self.v.bytes.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
        return text[1:] if text[:1] == " " else text


_encoders: dict = {}


def _encoder(model: bytes, dropout: float, seed: int, epoch: int) -> Encoder:
    """One vocabulary per worker and model."""
    mark = xxhash.xxh3_64_intdigest(model)
    if mark not in _encoders:
        _encoders.clear()
        _encoders[mark] = Vocabulary(model)
    return Encoder(_encoders[mark], dropout, seed, epoch)


def encode_texts(docs: DataFrame, model_path: str | None = None, dropout: float = DROPOUT, seed: int = SEED,
                 epoch: int = 0) -> DataFrame:
    """``doc_id, n_pieces, ids ARRAY<INT>, lossless`` per document.

    ``lossless`` tells that decoding ``ids`` gave the text again.  NULL and empty
    texts have no pieces (NULL decodes to the empty text).  The segmentation
    depends on doc_id (NULL as 0), text, seed and epoch alone; ``dropout`` 0 gives
    the model's own.  Repeated rows give equal rows.  Other columns are ignored.
    """
    with open(model_path or default_model(), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> dict:
        encoder = _encoder(shared.value, dropout, seed, epoch)
        bodies = batch.column("text").to_pylist()
        ids = encoder.encode([k or 0 for k in batch.column("doc_id").to_pylist()], bodies)
        same = [encoder.decode(x) == (t or "") for x, t in zip(ids, bodies)]
        return {"doc_id": batch.column("doc_id"), "n_pieces": pa.array([len(x) for x in ids], pa.int64()),
                "ids": list_array(ids, pa.int32()), "lossless": pa.array(same, pa.bool_())}

    return map_arrow(texts(docs), run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode_texts(pieces: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; a NULL list gives a NULL text."""
    with open(model_path or default_model(), "rb") as f:
        shared = pieces.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> dict:
        encoder = _encoder(shared.value, 0.0, SEED, 0)
        out = [None if x is None else encoder.decode(np.asarray(x, dtype=np.int64)) for x in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "text": pa.array(out, pa.string())}

    rows = pieces.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return map_arrow(rows, run, "doc_id long, text string")
