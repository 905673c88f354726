"""Run registered queries in Spark and their SQL in DuckDB; compare whole results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from setgraph.plans import ORACLE_SQL, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    t1 = time.time()
    rel = con.sql(ORACLE_SQL[name])
    dcols = rel.columns
    order = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
    drows = rel.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
           "columns_match": order is not None}
    if order is not None:
        drows = sorted(tuple(_norm(r[i]) for i in order) for r in drows)
        res["values_match"] = drows == srows
        if not res["values_match"]:
            sd, dd = set(srows), set(drows)
            res["only_spark"] = sorted(sd - dd)[:3]
            res["only_oracle"] = sorted(dd - sd)[:3]
    else:
        res["spark_cols"], res["oracle_cols"] = cols, dcols
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from setgraph.plans import QUERIES
    from setgraph.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    ok = True
    for name in names or QUERIES:
        r = compare(spark, con, name, sf_dir)
        ok &= bool(r.get("values_match")) and r["spark_rows"] == r["oracle_rows"]
        print(r, flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
