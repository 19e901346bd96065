"""Every registered query against its DuckDB oracle on the smoke tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck_connection

from martforge.plans.registry import build_queries
from warehouse_oracle import oracle_queries

QUERIES = build_queries()
SQL = oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con(smoke_dir):
    return duck_connection(smoke_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, smoke_dir, name):
    res = compare(QUERIES[name](spark, smoke_dir), con, SQL[name])
    assert res["ok"], res


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["dt", "gmv", "order_cnt", "customer_cnt", "avg_order_amt"]
    assert df.count() == 434
