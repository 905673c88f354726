import random

import pytest

from setgraph.llm.line_dedup import dedup_lines, drop_repeated_lines

from .conftest import prose, plain


def within_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs: dict, least: int = 24):
    places = sorted((i, no, line) for i, t in docs.items() if t is not None for no, line in enumerate(t.split("\n")))
    first: dict[str, tuple] = {}
    for i, no, line in places:
        if line.strip(" \t\r\x0b\x0c"):
            first.setdefault(line, (i, no))
    long = [x for x in first if len(x) >= least]
    near = {x for x in long for y in long if first[y] < first[x] and x != y and within_one(x, y)}
    out = []
    for i, t in docs.items():
        if t is None:
            out.append((i, 0, 0, 0, None))
            continue
        stay, exact, close = [], 0, 0
        for no, line in enumerate(t.split("\n")):
            if line not in first:
                stay.append(line)
            elif first[line] != (i, no):
                exact += 1
            elif line in near:
                close += 1
            else:
                stay.append(line)
        out.append((i, len(t.split("\n")), exact, close, "\n".join(stay)))
    return sorted(out, key=repr)


def edited(r: random.Random, line: str) -> str:
    at, kind = r.randrange(len(line) + 1), r.randrange(3)
    if kind == 0:
        return line[:at] + r.choice("xyzé") + line[at:]
    at = min(at, len(line) - 1)
    return line[:at] + ("" if kind == 1 else r.choice("XYZ")) + line[at + 1:]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    pool = [prose(100 * seed + i, r.randrange(5, 9)) for i in range(12)] + ["short", "", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    for _ in range(2):  # edits, and edits of edits
        pool += [edited(r, x) for x in pool if len(x) > 24]
    docs = {i: "\n".join(r.choice(pool) for _ in range(r.randrange(0, 8))) for i in range(30)}
    docs[30] = None
    got = plain(dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string")))
    want = brute(docs, 24)
    assert got == want
    assert sum(w[3] for w in want) > 3


def test_edits_at_every_place(spark):
    line = prose(7, 12)[:31]
    lines = [line] + [line[:i] + "#" + line[i:] for i in range(len(line) + 1)] + [line[:i] + line[i + 1:] for i in range(len(line))] \
        + [line[:i] + "%" + line[i + 1:] for i in range(len(line))]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dedup_lines(df).collect()}
    assert got[0] == line and all(t == "" for i, t in got.items() if i)


def test_odd_rows(spark, odd, none):
    got = {r["doc_id"]: tuple(r) for r in dedup_lines(odd).where("doc_id > 2").collect()}
    assert got[3] == (3, 0, 0, 0, None) and got[4] == (4, 1, 0, 0, "") and got[5][4] == " \t\n "
    both = [tuple(r) for r in dedup_lines(odd).where("doc_id = 2").collect()]
    assert both == [(2, 1, 1, 0, "")] * 2  # a repeated row, and equal to row 1
    assert got[10][2:] == (2, 0, "")  # its second line stands at the null id, which is first
    assert dedup_lines(odd).count() == odd.count() and dedup_lines(none).count() == 0
    kept = drop_repeated_lines(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    # the repeats of row 1 and the lines of the NULL id go; what had no words stays
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 11]
    assert drop_repeated_lines(none).count() == 0


def test_no_python_in_the_plan(spark, odd):
    plan = dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_counts_characters_anew(spark):
    t = prose(5, 9)
    df = spark.createDataFrame([(1, t, 99), (2, f"{t}\nend", 98), (3, "end", 97), (4, "fin", 96)], "doc_id long, text string, n_chars long")
    assert plain(drop_repeated_lines(df)) == [(1, t, 99), (2, "end", 3), (4, "fin", 96)]
