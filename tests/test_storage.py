"""Versioned tables, single-file exports, the text layer, rejects and bucketed tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

from martforge.functions.skew import frequent_keys, hot_keys
from martforge.operators import quality as Q
from martforge.operators import summaries as S
from martforge.operators.detail import trade_detail_from
from martforge.plans.pipeline import run_pipeline
from martforge.plans.sinks import (catalog_report, export_csv, export_report, register_all, run_export,
                                   write_table)
from martforge.schemas import RAW_SCHEMAS, schema_of
from martforge.sources.bucketed import read_bucketed, write_bucketed
from martforge.sources.landing import land_all, land_table, landing_report
from martforge.sources.raw import REJECTS, read_csv, read_table, reject_report
from martforge.sources.star import star_raw
from martforge.sources.text_layer import parse_lines, read_text_table, text_lines, write_text_table
from martforge.storage import KEEP, POINTER, Store, current_path, publish


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- versions ---------------------------------------------------------------

def test_a_failed_write_leaves_the_table(spark, tmp_dir):
    write_table(spark.range(10), tmp_dir, "t")
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_table(broken, tmp_dir, "t")
    assert read_table(spark, tmp_dir, "t").count() == 10
    assert [n for n in Store(spark, tmp_dir).names(f"{tmp_dir}/t") if n.startswith("v")] == [
        os.path.basename(current_path(spark, tmp_dir, "t"))]


def test_versions_are_swapped_and_pruned(spark, tmp_dir):
    for n in range(4):
        reader = None if n == 0 else read_table(spark, tmp_dir, "t")
        write_table(spark.range(n), tmp_dir, "t")
        assert read_table(spark, tmp_dir, "t").count() == n
        if reader is not None:  # resolved before the swap, still readable after it
            assert reader.count() == n - 1
    names = Store(spark, tmp_dir).names(f"{tmp_dir}/t")
    assert len([n for n in names if n.startswith("v")]) == KEEP and POINTER in names
    # a table may be rebuilt from itself
    write_table(read_table(spark, tmp_dir, "t").filter("id > 0"), tmp_dir, "t")
    assert read_table(spark, tmp_dir, "t").count() == 2


def test_a_plain_folder_is_read_and_then_replaced(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/t")
    assert read_table(spark, tmp_dir, "t").count() == 5
    publish(spark, tmp_dir, "t", lambda p: spark.range(7).write.parquet(p))
    assert read_table(spark, tmp_dir, "t").count() == 7
    assert not [n for n in Store(spark, tmp_dir).names(f"{tmp_dir}/t") if n.startswith("part-")]


# --- exports ------------------------------------------------------------------

def test_single_file_is_sorted_and_written_in_parts(spark, tmp_dir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        days = spark.range(0, 3000, 1, 6).select(F.format_string("d%06d", F.col("id") * 7919 % 3000).alias("dt"),
                                                 F.lit("a, b").alias("order_status"), F.col("id").alias("order_cnt"))
        assert export_csv(days, f"{tmp_dir}/out", name="order_status_day") == 3000
        plan = days.orderBy("dt")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "rangepartitioning" in plan
    files = [f for f in os.listdir(f"{tmp_dir}/out") if not f.startswith((".", "_"))]
    assert files == ["part-00000.csv"]
    with open(f"{tmp_dir}/out/part-00000.csv") as f:
        lines = f.read().splitlines()
    assert lines[0] == "dt,order_status,order_cnt" and len(lines) == 3001
    assert [x.split(",")[0] for x in lines[1:]] == [f"d{i:06d}" for i in range(3000)]
    assert spark.read.csv(f"{tmp_dir}/out", header=True).filter("order_status = 'a, b'").count() == 3000
    assert export_csv(days.limit(0), f"{tmp_dir}/out", name="order_status_day") == 0  # replaced: a header only
    with open(f"{tmp_dir}/out/part-00000.csv") as f:
        assert f.read() == "dt,order_status,order_cnt\n"


def test_a_failed_export_keeps_the_old_file(spark, tmp_dir):
    export_csv(spark.range(3), f"{tmp_dir}/x")
    with pytest.raises(Exception, match="broken"):
        export_csv(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), f"{tmp_dir}/x")
    assert spark.read.csv(f"{tmp_dir}/x", header=True).count() == 3
    assert sorted(os.listdir(tmp_dir)) == ["x"]


def test_concurrent_exports_are_reported_in_order(spark, tmp_dir):
    for name in ("a", "b", "c"):
        write_table(spark.range(ord(name)), tmp_dir, name)
    report = run_export(spark, tmp_dir, ["c", "gone", "a", "b"], f"{tmp_dir}/out")
    rows = [tuple(r) for r in export_report(spark, report).collect()]
    assert [r[:3] for r in rows] == [("c", "ok", 99), ("gone", "failed", None), ("a", "ok", 97), ("b", "ok", 98)]
    assert "PATH_NOT_FOUND" in rows[1][3]


def test_catalog_is_set_beside_the_contract(spark, tmp_dir):
    good = spark.sql("SELECT '1995-01' month_dt, 'a' payment_type, 1.00BD gmv, 2L order_cnt")
    write_table(good, tmp_dir, "payment_type_month")
    publish(spark, tmp_dir, "payment_dist", lambda p: good.select(
        "payment_type", F.col("gmv").cast("double").alias("gmv"), "order_cnt", F.lit(1).alias("more")).write.parquet(p))
    publish(spark, tmp_dir, "own", lambda p: good.select("gmv").write.parquet(p))
    names = ["payment_type_month", "payment_dist", "own", "gmv_month"]
    assert {r.tableName for r in register_all(spark, tmp_dir, "mf_report", names).collect()} == set(names[:3])
    got = {(r.tbl, r["column"]): (r.status, r.type) for r in catalog_report(spark, "mf_report", names).collect()}
    assert {s for (t, _), (s, _) in got.items() if t == "payment_type_month"} == {"ok"}
    assert got["payment_dist", "gmv"] == ("type", "double") and got["payment_dist", "payment_type"][0] == "comment"
    assert got["payment_dist", "more"][0] == "extra" and got["payment_dist", "gmv_pct"] == ("missing", "decimal(5,2)")
    assert got["own", "gmv"][0] == "free"
    assert {s for (t, _), (s, _) in got.items() if t == "gmv_month"} == {"missing"}


# --- text layer -----------------------------------------------------------------

def test_text_layer_keeps_null_and_empty_apart(spark, tmp_dir):
    values = [None, "", "\\N", "\\", "a\tb", "line\nbreak", "\\t", "\\\\\t\\n", "cr\r", "é\u0000|", "x"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)] + [("y", None)], "s string, n int")
    for sep in ("\t", "|", ","):
        lines = text_lines(df, sep)
        assert lines.filter("value RLIKE '[\\n\\r]'").count() == 0
        assert _same(parse_lines(lines, df.schema, sep), df)
    back = parse_lines(spark.createDataFrame([("q",), ("r\tzz\tmore",)], "value string"), df.schema)
    assert sorted(map(tuple, back.collect())) == [("q", None), ("r", None)]
    row = spark.sql("SELECT '1995-01-01' dt, '' order_status, CAST(NULL AS BIGINT) order_cnt")
    write_text_table(row, tmp_dir, "order_status_day")
    assert read_text_table(spark, f"{tmp_dir}/order_status_day", "order_status_day").collect() == row.collect()


# --- rejects ----------------------------------------------------------------------

BAD = ("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
       "o1,1,p,s,d,1.00,2.00\no2,x,p,s,d,n/a,2.00\no3,,p,s,d,,\no4,2,p,s,d,12345678901.00,1\n"
       "o5,3,p\no6,4,p,s,d,1.0,2.0,surplus\n")


@pytest.mark.parametrize("multi_line", [False, True])
def test_rejects_name_column_and_value(spark, tmp_dir, multi_line):
    with open(f"{tmp_dir}/items.csv", "w") as f:
        f.write(BAD)
    schema = RAW_SCHEMAS["order_items"]
    df = read_csv(spark, f"{tmp_dir}/items.csv", schema, rejects=True, multi_line=multi_line)
    plain = read_csv(spark, f"{tmp_dir}/items.csv", schema, multi_line=multi_line)
    assert _same(df.drop(REJECTS), plain) and plain.count() == 6
    got = {(r["column"], r.value): r.cnt for r in reject_report(df).collect()}
    assert got[("order_item_id", "x")] == got[("price", "n/a")] == got[("price", "12345678901.00")] == 1
    assert {v for c, v in got if c == "<record>"} == {"o5,3,p", "o6,4,p,s,d,1.0,2.0,surplus"}
    assert len(got) == 5


def test_landing_counts_rejects_and_tells_absent_from_unreadable(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/order_items.csv", "w") as f:
        f.write(BAD)
    report = land_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/wh", {
        "sellers": "sellers.csv", "order_items": "order_items.csv"}, buckets=3)
    assert [tuple(r) for r in landing_report(spark, report).collect()] == [
        ("sellers", "skipped", None, None), ("order_items", "ok", 6, 5)]
    assert report[1]["rejected"] == {"order_item_id": 1, "price": 2, "<record>": 2}
    assert _same(read_bucketed(spark, f"{tmp_dir}/wh", "order_items"), read_table(spark, f"{tmp_dir}/wh", "order_items"))
    with pytest.raises(Exception):
        land_table(spark, "nosuchfs://host/x.csv", f"{tmp_dir}/wh", "orders")


# --- bucketed tables ------------------------------------------------------------------

def _order_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\([^)]*order_id[^)]*\)", plan)


def test_bucketed_tables_need_no_exchange_on_the_order(spark, tmp_dir, smoke_dir):
    raw = star_raw(spark, smoke_dir)
    write_bucketed(raw["order_items"], tmp_dir, "order_items", "order_id")
    write_bucketed(raw["orders"], tmp_dir, "orders", "order_id")
    write_bucketed(trade_detail_from(raw, "2026-01-01"), tmp_dir, "trade_detail", "order_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, orders, detail = (read_bucketed(spark, tmp_dir, n) for n in ("order_items", "orders", "trade_detail"))
        plain = read_table(spark, tmp_dir, "trade_detail")
        for fn in (Q.duplicate_groups, S.order_grain):
            assert _order_exchanges(fn(detail)) == [] and _order_exchanges(fn(plain))
            assert _same(fn(detail), fn(plain))
        orphans = Q.orphan_items(items, orders)
        assert _order_exchanges(orphans) == []
        assert _same(orphans, Q.orphan_items(raw["order_items"], raw["orders"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert read_bucketed(spark, tmp_dir, "trade_detail").columns == schema_of("trade_detail").names


def test_pipeline_buckets_unless_an_order_is_hot(spark, tmp_dir, smoke_dir):
    raw = star_raw(spark, smoke_dir)
    run_pipeline(spark, f"{tmp_dir}/a", raw=raw, etl_date="2026-01-01")
    path = current_path(spark, f"{tmp_dir}/a", "trade_detail")
    assert Store(spark, path).exists(f"{path}/_bucketing")
    hot = F.when(F.hash("product_id", "order_item_id") % 3 == 0, F.lit("o1")).otherwise(F.col("order_id"))
    raw["order_items"] = raw["order_items"].withColumn("order_id", hot)
    from martforge.plans import pipeline
    counted = pipeline.frequent_keys
    pipeline.frequent_keys = lambda df, keys: counted(df, keys, min_rows=500)
    try:
        run_pipeline(spark, f"{tmp_dir}/b", raw=raw, etl_date="2026-01-01")
    finally:
        pipeline.frequent_keys = counted
    path = current_path(spark, f"{tmp_dir}/b", "trade_detail")
    assert not Store(spark, path).exists(f"{path}/_bucketing")
    assert _same(read_table(spark, f"{tmp_dir}/b", "trade_detail"), trade_detail_from(raw, "2026-01-01"))


# --- hot keys ---------------------------------------------------------------------

def _exact(df, key, least):
    return sorted(r[key] for r in df.groupBy(key).count().filter(f"`{key}` IS NOT NULL AND count >= {least}").collect())


def test_summaries_find_the_same_keys_as_an_exact_count(spark):
    # 40,000 rows: shares of 1/3, then ever smaller ones, NULLs, and a long tail of single rows
    n = 40_000
    df = spark.range(0, n, 1, 7).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 11 = 0 THEN 'b' WHEN id % 50 = 1 THEN NULL "
               "WHEN id % 101 = 2 THEN concat('c', id % 4) ELSE concat('x', id) END").alias("k"),
        F.expr("CASE WHEN id < 500 THEN 7 ELSE id END").alias("m"), F.lit(1).alias("one"))
    for share in (0.2, 0.05, 0.0125, 0.004, 0.002):
        least = max(10, int(n * share))
        got = frequent_keys(df, ["k", "m", "one"], share, min_rows=10)
        assert got == {"k": _exact(df, "k", least), "m": _exact(df, "m", least), "one": [1]}
    assert hot_keys(df, "k", 0.3, min_rows=10) == ["a"] and hot_keys(df, "k", min_rows=10**6) == []
    assert frequent_keys(df.limit(0), ["k", "m"]) == {"k": [], "m": []}


def test_one_scan_and_no_shuffle_of_rows(spark, smoke_dir):
    items = star_raw(spark, smoke_dir)["order_items"]
    sc = spark.sparkContext
    sc.setJobGroup("hot", "hot")
    try:
        assert frequent_keys(items, ("order_id", "product_id")) == {"order_id": [], "product_id": []}
        jobs = sc.statusTracker().getJobIdsForGroup("hot")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert len(stages) <= 3  # the summaries and their merge
