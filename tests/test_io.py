import os
import tempfile

import pytest
from pyspark.sql import functions as F

from setgraph.operators import set_similarity_join, shortest_paths_to, word_count
from setgraph.sources import (parse_edges, parse_sets, read_edges, read_edges_checked, read_kv, read_paths, read_sets,
                              read_sets_checked, write_kv, write_pairs,
                              write_paths)


def _write(text):
    d = tempfile.mkdtemp(prefix="setgraph-io-")
    p = os.path.join(d, "in.txt")
    with open(p, "w") as f:
        f.write(text)
    return p


def _read_dir(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name)) as f:
                out.extend(f.read().splitlines())
    return out


def test_edges_text_round_trip(spark):
    p = _write("0 0 1 10.0\n1 1 2 3.0\n2 2 0 5\n")
    e = read_edges(spark, p)
    assert e.schema.simpleString() == "struct<edge_id:string,src:bigint,dst:bigint,dist:double>"
    out = os.path.join(tempfile.mkdtemp(prefix="setgraph-io-"), "paths")
    write_paths(shortest_paths_to(e, 0), out)
    assert _read_dir(out) == ["0\t0.0\t0", "1\t8.0\t1->2->0", "2\t5.0\t2->0"]


def test_bad_edge_rows(spark):
    lines = spark.createDataFrame([("0 1 2 3.5",), ("oops",), ("1 2 x 1.0",)], "value string")
    with pytest.raises(Exception):
        parse_edges(lines).collect()
    assert [tuple(r) for r in parse_edges(lines, on_bad_row="drop").collect()] == [("0", 1, 2, 3.5)]


@pytest.mark.parametrize("line", ["e x 2 3.0", "e 1 x 3.0", "e 1 2 x", "e 1 2"])
def test_each_used_field_is_checked(spark, line):
    good = ("e1 1 2 3.0",)
    lines = spark.createDataFrame([good, (line,)], "value string")
    with pytest.raises(Exception):
        parse_edges(lines).collect()
    assert [tuple(r) for r in parse_edges(lines, on_bad_row="drop").collect()] == [("e1", 1, 2, 3.0)]


def test_blank_set_line_fails(spark):
    lines = spark.createDataFrame([("1 2",), ("  ",)], "value string")
    with pytest.raises(Exception, match="blank"):
        parse_sets(lines).collect()
    assert parse_sets(lines, on_bad_row="drop").count() == 1


def test_composite_key_over_several_part_files(spark):
    df = spark.createDataFrame([(f"t{i % 50:02d}", f"u{i % 7}", i) for i in range(3500)], "a string, b string, n long")
    counts = df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    out = os.path.join(tempfile.mkdtemp(prefix="setgraph-io-"), "kv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_kv(counts, out, ["a", "b"], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = _read_dir(out)
    assert len([x for x in os.listdir(out) if x.startswith("part-")]) > 1
    assert got == sorted(got) and len(got) == counts.count() and got[0] == "t00 u0\t10"


def test_sets_text_and_pair_sink(spark):
    p = _write("0 1 4 5 6 \n1 2 3 6\n2 4 5 6\n3 1 4 6\n4 2 5 6\n5 3 5\n")
    s = read_sets(spark, p)
    assert s.schema.simpleString() == "struct<rid:bigint,tokens:array<bigint>>"
    out = os.path.join(tempfile.mkdtemp(prefix="setgraph-io-"), "pairs")
    write_pairs(set_similarity_join(s, 0.5), out)
    assert _read_dir(out) == ["(0,2)\t0.75", "(0,3)\t0.75", "(1,4)\t0.5", "(2,3)\t0.5", "(2,4)\t0.5"]


def test_bad_set_rows(spark):
    lines = spark.createDataFrame([("1 2 3",), ("x 1",), ("2 4 y",)], "value string")
    assert [tuple(r) for r in parse_sets(lines, on_bad_row="drop").collect()] == [(1, [2, 3])]


def test_kv_sink_sorted(spark):
    df = spark.createDataFrame([("b a c a",)], "text string")
    out = os.path.join(tempfile.mkdtemp(prefix="setgraph-io-"), "wc")
    write_kv(word_count(df), out, "term", "n")
    assert _read_dir(out) == ["a\t2", "b\t1", "c\t1"]


def test_bad_rows_fail_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lines = spark.createDataFrame([("0 1 x 3.5",)], "value string")
        with pytest.raises(Exception, match="malformed"):
            parse_edges(lines).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_rejects_have_file_place_and_reason(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 1 2 3.5\n1 x 2 3\n2 1 2\n3 4 5 6\n")
    (tmp_path / "b.txt").write_text("4 1 y z\n\n5 7 8 nine\n")
    good, rejects, counts = read_edges_checked(spark, str(tmp_path))
    assert sorted((r["src"], r["dst"], r["dist"]) for r in good.collect()) == [(1, 2, 3.5), (4, 5, 6.0)]
    assert sorted(tuple(r) for r in rejects.collect()) == [
        ("a.txt", 2, "src", "1 x 2 3"), ("a.txt", 3, "fields", "2 1 2"), ("b.txt", 1, "dst", "4 1 y z"),
        ("b.txt", 2, "fields", ""), ("b.txt", 3, "dist", "5 7 8 nine")]
    assert counts == {"lines": 7, "rejects": 5}


def test_places_count_over_the_blocks_of_a_file(spark, tmp_path):
    (tmp_path / "s.txt").write_text("".join("  \n" if i % 50 == 7 else f"{i} 1 two\n" if i % 50 == 9 else f"{i} {i + 1} 5 \n" for i in range(1000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        good, rejects, counts = read_sets_checked(spark, str(tmp_path))
        got = {(r["line_no"], r["reason"]) for r in rejects.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(i + 1, "blank") for i in range(7, 1000, 50)} | {(i + 1, "tokens") for i in range(9, 1000, 50)}
    assert counts == {"lines": 1000, "rejects": 40} and good.count() == 960


def test_sorted_folder_is_read_back_in_order(spark, tmp_path):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000 - 2500).alias("node"), F.lit(1.5).alias("dist"), F.array("id").alias("path")).repartition(5)
    write_paths(df, str(tmp_path / "p"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")     # parts are read in several blocks
    try:
        got = read_paths(spark, str(tmp_path / "p")).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert [r["line_no"] for r in got] == list(range(5000))
    assert [int(r["value"].split("\t")[0]) for r in got] == list(range(-2500, 2500))
    write_kv(df.limit(0).select(F.lit("a").alias("k"), "node"), str(tmp_path / "none"), "k", "node")
    assert read_kv(spark, str(tmp_path / "none"), "k").count() == 0


@pytest.mark.parametrize("fault", ["swap", "cut", "lost"])
def test_a_folder_that_is_not_as_written_is_told(spark, tmp_path, fault):
    write_kv(spark.range(0, 400).select("id", F.lit(1).alias("n")).repartition(3), str(tmp_path / "p"), "id", "n")
    parts = sorted(p for p in (tmp_path / "p").iterdir() if p.name.startswith("part-") and p.stat().st_size)
    lines = parts[0].read_text().splitlines(keepends=True)
    for crc in (tmp_path / "p").glob(".part-*.crc"):
        crc.unlink()
    if fault == "swap":
        lines[3], lines[4] = lines[4], lines[3]
    if fault == "lost":
        parts[-1].unlink()
    else:
        parts[0].write_text("".join(lines[:-1] if fault == "cut" else lines))
    with pytest.raises(ValueError, match="not as the manifest"):
        read_kv(spark, str(tmp_path / "p"), "id", "long")
