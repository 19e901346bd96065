"""Plan shape: the scale properties the operators rely on, read from explain().

* summaries read only the detail columns they use, with the status filter
  pushed into the Parquet scan;
* top-N marts are planned as TakeOrderedAndProject (per-task N best rows);
* no registered query contains a cross join, a nested-loop join or a Python
  UDF.
"""

import contextlib
import io
import re

import pytest

from martforge.operators import marts as M
from martforge.operators import summaries as S
from martforge.plans.pipeline import run_pipeline
from martforge.plans.registry import build_queries
from martforge.sources.raw import read_table

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def read_schemas(text: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<(.*)>", text)]


@pytest.fixture(scope="module")
def warehouse(spark, smoke_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    run_pipeline(spark, root, star_dir=smoke_dir, etl_date="2026-01-01")
    return root


def test_summary_scan_is_pruned_and_filtered(spark, warehouse):
    detail = read_table(spark, warehouse, "trade_detail")
    text = plan_text(S.gmv_day(detail))
    schemas = read_schemas(text)
    assert schemas, text
    used = {"order_status", "order_purchase_date", "order_id", "customer_id",
            "payment_value_sum"}
    for cols in schemas:
        assert cols <= used, cols
    assert "EqualTo(order_status,delivered)" in text


def test_top_n_marts_take_ordered(spark, warehouse):
    sales = read_table(spark, warehouse, "product_sales")
    for df in (M.product_topn(sales), M.category_topn(sales)):
        text = plan_text(df)
        assert "TakeOrderedAndProject" in text, text


def test_no_cross_join_or_python_in_registered_queries(spark, smoke_dir):
    for name, q in build_queries().items():
        text = plan_text(q(spark, smoke_dir))
        found = [op for op in FORBIDDEN if op in text]
        assert not found, (name, found)
