"""Merge-dropout against a plain encoder that looks at all neighbours before every merge."""

import random

import numpy as np
import pytest
import xxhash

from setgraph.llm import sentencepiece as sp
from setgraph.llm.common import finish

from .conftest import prose


@pytest.fixture(scope="module")
def vocabulary():
    with open(sp.default_model(), "rb") as f:
        return sp.Vocabulary(f.read())


def plain_word(v, word, key, limit):
    symbols, dropped = [(i, int(v.symbol[ord(c)])) for i, c in enumerate(word)], set()
    while True:
        open_ = []
        for k, ((at, a), (_, b)) in enumerate(zip(symbols, symbols[1:])):
            piece = v.pairs.get((a, b))
            if piece is not None and (at, piece) not in dropped:
                open_.append((int(v.rank[piece]), at, k, piece))
        if not open_:
            break
        _, at, k, piece = min(open_)
        if sp._skipped(key, np.array([at]), np.array([piece]), limit)[0]:
            dropped.add((at, piece))
        else:
            symbols[k:k + 2] = [(at, piece)]
    out = []
    for _, s in symbols:
        out += [s] if s < v.size else [v.byte_piece[b] for b in chr(s - v.size).encode()]
    return out


def plain_text(v, e, key, text):
    out = []
    for place, word in enumerate(sp._WORD.findall(" " + text)):
        spot = finish(finish(np.array([key], np.uint64) + np.uint64(e.seed)) + np.uint64(place) * sp._G)
        out += plain_word(v, word, finish(np.uint64(xxhash.xxh3_64_intdigest(word.encode())) + spot), e.limit)
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_pieces_are_those_of_a_plain_encoder(vocabulary, dropout):
    r = random.Random(7)
    texts = [prose(k, 40) + "\n" + " ".join(r.choice(["the", "internationalisation", "Straße", "日本語", "a" * 40, "▁x", "  two"]) for _ in range(20)) for k in range(4)]
    e = sp.Encoder(vocabulary, dropout)
    for key, (text, got) in enumerate(zip(texts, e.encode(list(range(4)), texts))):
        assert got.tolist() == plain_text(vocabulary, e, key, text)
        assert e.decode(got) == text
