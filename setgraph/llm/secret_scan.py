"""Secret scans: fixed patterns, and an assignment-aware lexer with scores by name.

The fixed patterns (``assign``, ``access``, ``hex``) give the base spans.  The
lexer (:mod:`setgraph.llm.assignments`) reads the assignments of source and configuration
syntax into pairs of a target name and the literals and names of its expression.
Constants are propagated: a name in an expression stands for the literals that
the text assigned to it before, so that in ``k = "..."; password = k`` the literal
is scored under the target ``password``.  A literal's score grows with how
sensitive its target's words are and how random its characters look; literals
that reach ``MIN_SCORE`` and that no base span covers are added (``literal``).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .assignments import assignments
from .common import map_arrow, texts

MIN_SCORE = 0.6
MIN_LITERAL = 6

# The base patterns, the least characters of each match (of the
# second group for 'assign') and the order of the kinds.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

# Cheap tests over a batch that tell which texts can match at all.
_MAYBE = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{24}"}

# How sensitive a word of a target name is; words of the second set speak against it.
_WORDS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 0.9, "apikey": 0.9, "token": 0.8,
          "credential": 0.9, "credentials": 0.9, "private": 0.5, "access": 0.3, "api": 0.3, "auth": 0.5, "key": 0.5,
          "signing": 0.4, "encryption": 0.4, "bearer": 0.7, "salt": 0.4, "webhook": 0.4, "connection": 0.3, "dsn": 0.5}
_AGAINST = {"id", "name", "url", "uri", "path", "file", "count", "size", "length", "type", "hint", "policy", "public", "field",
            "label", "expiry", "expires", "timeout", "limit", "max", "min"}
# No literal reaches a score without such a word in its text.
_MAYBE["literal"] = "(?i)" + "|".join(_WORDS)
_PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|-+|null|none|true|false|change.?me|example|your([\W_].*)?|todo|undefined|<.*>?)$")

_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str, kinds: set[str]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns' matches."""
    out = []
    for kind, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)):
        if kind in kinds:
            out += [(*m.span(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= LEAST[kind]]
    return out


def name_score(name: str, around: float = 0.0) -> float:
    """How sensitive a target name is, 0 to 1, from its snake, dash or camel case words;
    the score of the key around it counts four fifths."""
    words = [w.lower() for w in _PARTS.findall(name)]
    if words and words[-1] in _AGAINST:
        return 0.0
    return min(1.0, max(sum(_WORDS.get(w, 0.0) for w in set(words)), 0.8 * around))


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: bits per character and classes.  A
    phrase of words counts unless it speaks of a secret, as the text of a prompt does."""
    if len(value) < MIN_LITERAL or _PLACEHOLDER.match(value):
        return 0.0
    if any(c.isspace() for c in value) and any(_WORDS.get(w.lower(), 0.0) >= 0.8 for w in _PARTS.findall(value)):
        return 0.0
    n = len(value)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, bits / 4.0) * 0.7 + min(classes, 3) / 3.0 * 0.3


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals whose score under the most sensitive target that they reach
    is MIN_SCORE or more."""
    found = assignments(text)
    names: list[float] = []
    for a in found:
        names.append(name_score(a.name, 0.0 if a.around is None else names[a.around]))
    reached: dict[tuple[int, int], float] = {}
    for i in range(len(found) - 1, -1, -1):  # references go back, so later targets come first
        for k in found[i].refers:
            names[k] = max(names[k], names[i])
        for span in found[i].literals:
            reached[span] = max(reached.get(span, 0.0), names[i])
    out = []
    for (a, b), sensitive in reached.items():
        looks = literal_score(text[a:b]) if sensitive > 0.3 else 0.0
        if looks > 0.3 and 0.6 * sensitive + 0.4 * looks >= MIN_SCORE:
            out.append((a, b, "literal"))
    return sorted(out)


def scan_text(text: str, kinds: set[str] = frozenset(KINDS)) -> list[tuple[int, int, str]]:
    """All spans of a text, by start and kind; a literal inside a base span is that span."""
    spans = sorted(base_spans(text, kinds))
    if "literal" in kinds:
        starts = [s[0] for s in spans]
        ends = list(accumulate((s[1] for s in spans), max))  # the furthest end of the spans so far
        for a, b, kind in literal_spans(text):
            before = bisect_right(starts, a)
            if not before or ends[before - 1] < b:
                spans.append((a, b, kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal`` per document.

    Spans are in code points, the end exclusive, as ``kind:start:end`` by start, then
    kind.  NULL text is empty; repeated rows give equal rows; NULL ids are
    carried.  Other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        column = batch.column("text")
        maybe = {k: pc.fill_null(pc.match_substring_regex(column, p), False).to_pylist() for k, p in _MAYBE.items()}
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        base, every = [], []
        for i in range(batch.num_rows):
            kinds = {k for k in KINDS if maybe[k][i]}
            spans = scan_text(column[i].as_py(), kinds) if kinds else []
            count = Counter(k for *_, k in spans)
            for k in KINDS:
                counts[k].append(count[k])
            base.append(hashlib.sha256(joined([s for s in spans if s[2] != "literal"]).encode()).hexdigest())
            every.append(joined(spans))
        n = {k: pa.array(v, pa.int64()) for k, v in counts.items()}
        return {"doc_id": batch.column("doc_id"), "n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"],
                "base_sha256": pa.array(base, pa.string()), "spans": pa.array(every, pa.string()), "n_literal": n["literal"]}

    return map_arrow(texts(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                       "spans string, n_literal long")
