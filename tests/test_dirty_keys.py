"""Spark vs. the SQL oracle on a small star schema with dirty keys.

The test tables have unique order / customer / part keys. Here a seeded
random schema has duplicate keys everywhere (orders, customers, parts,
order lines), orphans and heavy ties in dates and amounts, so join fan-out,
the shared order-level table and the rank tie-breakers are all exercised
against the literal SQL.
"""

import datetime as dt
import random

import pandas as pd
import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck_connection

CHECKED = ["payment_rollup", "trade_detail", "gmv_day", "product_sales", "region_day",
           "city_day", "payment_type_day", "user_order_summary", "product_topn",
           "region_sales_rank", "order_status_day", "gmv_month", "payment_dist",
           "category_topn", "city_sales", "dq_report", "chart_category_top3",
           "chart_payment_month_share"]


def _write_star(path, seed=5):
    rnd = random.Random(seed)
    days = [dt.datetime(1995, 1, 1) + dt.timedelta(days=d) for d in (0, 1, 30, 31, 400)]
    prices = [10.0, 20.0, 20.0, 35.5]
    orders = pd.DataFrame({
        "o_orderkey": [rnd.randrange(0, 120) for _ in range(160)],
        "o_custkey": [rnd.randrange(0, 30) for _ in range(160)],
        "o_orderstatus": [rnd.choice("FFFOP") for _ in range(160)],
        "o_totalprice": [rnd.choice(prices) for _ in range(160)],
        "o_orderdate": [rnd.choice(days) for _ in range(160)],
        "o_orderpriority": [rnd.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT", "5-LOW"])
                            for _ in range(160)],
    })
    lineitem = pd.DataFrame({
        "l_orderkey": [rnd.randrange(0, 130) for _ in range(500)],
        "l_partkey": [rnd.randrange(0, 25) for _ in range(500)],
        "l_suppkey": [rnd.randrange(0, 5) for _ in range(500)],
        "l_linenumber": [rnd.randrange(1, 4) for _ in range(500)],
        "l_quantity": [float(rnd.randrange(1, 5)) for _ in range(500)],
        "l_extendedprice": [rnd.choice(prices) for _ in range(500)],
        "l_discount": [0.0] * 500, "l_tax": [0.0] * 500,
        "l_returnflag": ["N"] * 500, "l_linestatus": ["O"] * 500,
        "l_shipdate": [rnd.choice(days) for _ in range(500)],
    })
    customer = pd.DataFrame({
        "c_custkey": [rnd.randrange(0, 28) for _ in range(40)],
        "c_name": [f"name{i}" for i in range(40)],
        "c_nationkey": [rnd.randrange(0, 3) for _ in range(40)],
        "c_acctbal": [0.0] * 40,
        "c_mktsegment": [rnd.choice(["A", "B"]) for _ in range(40)],
    })
    nation = pd.DataFrame({"n_nationkey": [0, 1, 2], "n_name": ["N0", "N1", "N2"],
                           "n_regionkey": [0, 0, 1]})
    part = pd.DataFrame({
        "p_partkey": [rnd.randrange(0, 24) for _ in range(30)],
        "p_name": ["p"] * 30, "p_brand": ["b"] * 30,
        "p_type": [rnd.choice(["SMALL", "LARGE", "PROMO"]) for _ in range(30)],
        "p_size": [rnd.randrange(1, 9) for _ in range(30)],
        "p_retailprice": [1.0] * 30,
    })
    region = pd.DataFrame({"r_regionkey": [0, 1], "r_name": ["R0", "R1"]})
    supplier = pd.DataFrame({"s_suppkey": list(range(5)), "s_name": ["s"] * 5,
                             "s_nationkey": [0, 1, 2, 0, 1], "s_acctbal": [0.0] * 5})
    types = {"o_orderkey": "int64", "o_custkey": "int64", "l_orderkey": "int64",
             "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int32",
             "c_custkey": "int64", "c_nationkey": "int32", "n_nationkey": "int32",
             "n_regionkey": "int32", "p_partkey": "int64", "p_size": "int32",
             "s_suppkey": "int64", "s_nationkey": "int32", "r_regionkey": "int32"}
    for name, df in [("orders", orders), ("lineitem", lineitem), ("customer", customer),
                     ("nation", nation), ("part", part), ("supplier", supplier),
                     ("region", region)]:
        for c in df.columns:
            if c in types:
                df[c] = df[c].astype(types[c])
            elif df[c].dtype.kind == "M":
                df[c] = df[c].astype("datetime64[us]")
        df.to_parquet(f"{path}/{name}.parquet", index=False)


@pytest.fixture(scope="module")
def dirty_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("dirty_star")
    _write_star(str(path))
    return str(path)


@pytest.mark.parametrize("name", CHECKED)
def test_dirty_keys_match_oracle(spark, dirty_dir, name):
    con = duck_connection(dirty_dir)
    res = compare(E.queries()[name](spark, dirty_dir), con, E.oracle_sql()[name])
    assert res["ok"], res
