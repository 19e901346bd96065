"""What keeps the larger tables within a task's memory and the time limit."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martforge.operators import quality as Q
from martforge.plans import registry
from martforge.sources import text_layer as TL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_groups_are_held_apart_from_the_joins(spark, smoke_dir):
    rows = [("o1", 1), ("o1", 1), ("o1", 2), (None, 1), (None, 1), ("o2", None), ("o2", None), ("o3", 1)]
    items = spark.createDataFrame(rows, "order_id string, order_item_id int")
    orders = items.select("order_id").distinct().union(spark.createDataFrame([(None,)], "order_id string"))
    for lazy in (False, True):
        assert Counter(map(tuple, Q.duplicate_groups(items, lazy).collect())) == Counter(
            [(*k, n) for k, n in Counter(rows).items() if n > 1])
        assert Q.duplicate_check(items, lazy).first()[0] == 3
    # the join's stage ends in a shuffle before anything is grouped
    joined = plan(Q.duplicate_groups(items.join(orders.hint("merge"), "order_id"), lazy=True))
    assert "REPARTITION_BY_NUM" in joined[:joined.index("Join")]
    for name in ("dq_duplicate_groups", "dq_duplicates", "dq_report"):
        assert "REPARTITION_BY_NUM" in plan(registry.build_queries()[name](spark, smoke_dir))


@pytest.mark.parametrize("sep", ["\t", "|", ".", "\x01", ",", "^"])
def test_text_lines_survive_any_separator(spark, sep):
    texts = ["", "plain", "a|b", "t\tb\\t", "\\", "\\\\n\n", "\\N", None, "x.y,z\x01\r", "\\s"]
    schema = "n int, t string, d decimal(10,2), u string"
    rows = [(None if i == 3 else -i, t, None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, schema)
    got = TL.parse_lines(TL.text_lines(df, sep), df.schema, sep)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, df.collect()))


def test_only_values_that_need_it_are_escaped(spark):
    numbers = spark.range(3).select(F.col("id").cast("decimal(10,2)").alias("d"), "id")
    assert "replace" not in plan(TL.text_lines(numbers))
    assert "contains" in plan(TL.parse_lines(spark.createDataFrame([("a",)], "value string"),
                                             numbers.limit(0).select(F.lit("").alias("t")).schema)).lower()
    assert TL._pattern("\t") == "\t" and TL._pattern("|") == "\\|"


def test_the_exported_marts_share_one_order_grain(spark, smoke_dir):
    stored, lazy = registry._wh_stored(spark, smoke_dir), registry._wh(spark, smoke_dir)
    for name in ("gmv_month", "payment_dist", "region_sales_month"):
        assert "lineitem" not in plan(getattr(stored, name))
        assert "lineitem" in plan(getattr(lazy, name))
        assert Counter(map(tuple, getattr(stored, name).collect())) == Counter(
            map(tuple, getattr(lazy, name).collect()))
