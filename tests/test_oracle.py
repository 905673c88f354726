"""Every registered query against its DuckDB statement, on the smallest tables."""

import pytest

import __spark_entry__ as entry_mod
from setgraph.plans import QUERIES

from .conftest import SF_SMALL
from .oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in entry_mod.queries() and name in entry_mod.oracle_sql()
    r = compare(spark, con, name, SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["id1", "id2", "sim"]
    assert df.count() > 0
