"""Registered queries that SQL can express, against their DuckDB statements; and the registry."""

import pytest

import __spark_entry__ as entry
from setgraph.llm import ORACLE_SQL, QUERIES

from ..oracle_compare import duck
from .conftest import SF, plain


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = duck(SF).sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]}) q").fetchall()
    assert plain(got.select(cols)) == sorted(want, key=repr)


def test_registry():
    names = set(entry.queries())
    assert {*QUERIES, "pipeline"} <= names and {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLE_SQL) <= set(QUERIES) and set(entry.oracle_sql()) <= names
