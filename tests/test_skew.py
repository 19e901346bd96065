"""Hot keys: one order holding a third of all items."""

import re

import pytest
from pyspark.sql import functions as F

from martforge.functions.skew import hot_keys, salted_join
from martforge.operators import summaries as S
from martforge.operators.detail import trade_detail_from
from martforge.sources.star import star_raw


def _skewed_raw(spark, smoke_dir):
    raw = star_raw(spark, smoke_dir)
    items = raw["order_items"]
    hot = F.abs(F.hash("product_id", "order_item_id", "order_id")) % 3 == 0
    raw["order_items"] = items.withColumn(
        "order_id", F.when(hot, F.lit("o1")).otherwise(F.col("order_id")))
    return raw


def test_hot_keys_finds_the_hot_order(spark, smoke_dir):
    items = _skewed_raw(spark, smoke_dir)["order_items"].select("order_id")
    assert hot_keys(items, "order_id", min_rows=20) == ["o1"]
    plain = star_raw(spark, smoke_dir)["order_items"].select("order_id")
    assert hot_keys(plain, "order_id", min_rows=20) == []
    # every key with the share comes back; there is no cap
    many = spark.range(2000).select((F.col("id") % 20).cast("string").alias("k"))
    assert len(hot_keys(many, "k", min_share=0.05, min_rows=1)) == 20
    assert hot_keys(spark.range(0).selectExpr("CAST(id AS STRING) k"), "k") == []


def test_salted_detail_equals_the_plain_one(spark, smoke_dir):
    raw = _skewed_raw(spark, smoke_dir)
    salted = trade_detail_from(raw, "2026-01-01", {"order_id": ["o1"], "product_id": ["p1", "p7"]})
    plain = trade_detail_from(raw, "2026-01-01")
    assert salted.count() == plain.count() > 0
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    a, b = S.gmv_day(salted), S.gmv_day(plain)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", salted._jdf.queryExecution().toString()
                       .split("== Physical Plan ==")[1])
    assert sum("l_orderkey" in s for s in scans) == 1  # items are scanned once


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_keeps_unmatched_and_null_keys(spark, how):
    big = spark.createDataFrame([("h", i) for i in range(50)] + [("a", 2), (None, 3), ("z", 4)],
                                "k string, v int")
    other = spark.createDataFrame([("h", "H"), ("a", "A"), ("a", "B")], "k string, w string")
    got, exp = salted_join(big, other, "k", how, ["h", "z"], salts=5), big.join(other, "k", how)
    assert got.columns == exp.columns
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_building_a_query_runs_no_job(spark, smoke_dir):
    from martforge.plans.registry import WRITING, build_queries
    # full rankings and the all-state matrix need figures from the data, CSV keys write
    eager = {"region_sales_rank", "chart_region_top15", "chart_gmv_mom", "chart_region_month_matrix"}
    sc = spark.sparkContext
    sc.setJobGroup("build-only", "build-only")
    try:
        for name, query in build_queries().items():
            if name not in {*eager, *WRITING} and not name.startswith("csv_roundtrip"):
                query(spark, smoke_dir)
        assert list(sc.statusTracker().getJobIdsForGroup("build-only")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_summaries_of_a_unique_grain_are_not_regrouped(spark, smoke_dir, tmp_dir):
    grain = S.order_grain(trade_detail_from(star_raw(spark, smoke_dir), "2026-01-01"))
    grain.write.parquet(f"{tmp_dir}/grain")
    grain = spark.read.parquet(f"{tmp_dir}/grain")
    assert S.one_row_per_order(grain)
    assert not S.one_row_per_order(grain.union(grain))
    for fn in (S.gmv_day, S.region_day, S.city_day, S.payment_type_day, S.user_order_summary):
        once, again = fn(grain=grain, regroup=False), fn(grain=grain)
        assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\([^)]*order_purchase_date[^)]*order_id", plan)
