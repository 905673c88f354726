"""Small pure-Python brute-force checkers for tests (tiny inputs only)."""

from __future__ import annotations

import heapq
import re

# The term delimiters, and the carriage return.
DELIMS = set(" *$&#/\t\n\f\"'\\,.:;?![](){}<>~-_\r")


def tokenize(line: str) -> list[str]:
    out, cur = [], []
    for ch in line:
        if ch in DELIMS:
            if cur:
                out.append("".join(cur))
                cur = []
        else:
            cur.append(ch)
    if cur:
        out.append("".join(cur))
    return [t.lower() for t in out]


def lines(text: str) -> list[str]:
    return re.split(r"\r\n|\r|\n", text)


def jaccard_all_pairs(records: dict[int, list], t: float) -> list[tuple[int, int, float]]:
    """Nested-loop exact Jaccard over every pair of records."""
    ids = sorted(records)
    sets = {i: set(records[i]) for i in ids}
    out = []
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if not a or not b:
                continue
            sim = len(a & b) / len(a | b)
            if sim >= t:
                out.append((i, j, sim))
    return out


def shortest_to(edges: list[tuple[int, int, float]], target: int) -> dict[int, tuple[float, int, list[int]]]:
    """Dijkstra on reversed edges with the (dist, hops, next) tie rule."""
    best: dict[tuple[int, int], float] = {}
    for s, d, w in edges:
        best[(s, d)] = min(w, best.get((s, d), float("inf")))
    rin: dict[int, list[tuple[int, float]]] = {}
    for (s, d), w in best.items():
        rin.setdefault(d, []).append((s, w))
    if target not in rin:
        return {}
    key = {target: (0.0, 0, -1)}
    heap = [(0.0, 0, -1, target)]
    done = set()
    while heap:
        d, h, nx, v = heapq.heappop(heap)
        if v in done:
            continue
        done.add(v)
        for u, w in rin.get(v, []):
            cand = (d + w, h + 1, v)
            if u not in key or cand < key[u]:
                key[u] = cand
                heapq.heappush(heap, (*cand, u))
    out = {}
    for v, (d, h, nx) in key.items():
        path, cur = [v], v
        while key[cur][2] != -1:
            cur = key[cur][2]
            path.append(cur)
        out[v] = (d, h, path)
    return out
