"""The driver's correctness gate, run locally: every registered query against
its DuckDB oracle at sf0.01 (columns, types, order-insensitive values)."""

import pytest

import __spark_entry__ as entry_module

from .conftest import SF01
from .oracle_compare import compare, duck

# the library's own queries; those of the llm subpackage are tested with it
QUERIES = {k: v for k, v in entry_module.queries().items() if k in entry_module._QUERIES}
ORACLE = {k: v for k, v in entry_module.oracle_sql().items() if k in entry_module._QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF01)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    n = df.count()
    assert n > 0
    assert df.columns == ["id", "cust_key", "order_status", "total_price", "order_date",
                          "order_priority"]
