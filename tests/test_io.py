"""CSV sources, landing, export, catalog and the full pipeline."""

import os

from pyspark.sql import functions as F

from martforge.plans.pipeline import run_pipeline
from martforge.plans.sinks import export_csv, preview, register_all, run_export, write_table
from martforge.schemas import MART_TABLES, RAW_SCHEMAS
from martforge.sources.landing import land_all, row_counts
from martforge.sources.raw import read_source, read_table
from martforge.sources.star import star_raw

REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,"nice, really","line one\nline two",2017-01-01,2017-01-02\n'
    'r2,o2,x,,"",2017-01-03,2017-01-04\n'
    'r3,"o3",4,"say ""hi""",plain,2017-01-05,2017-01-06\n'
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_quoting_newline_empty_and_bad_number(spark, tmp_dir):
    _write(f"{tmp_dir}/order_reviews/part.csv", REVIEWS)
    rows = {r.review_id: r for r in read_source(spark, tmp_dir, "order_reviews").collect()}
    assert rows["r1"].review_comment_title == "nice, really"
    assert rows["r1"].review_comment_message == "line one\nline two"
    assert rows["r2"].review_score is None  # bad number -> NULL, row kept
    assert rows["r2"].review_comment_title is None
    assert rows["r3"].order_id == "o3" and rows["r3"].review_comment_title == 'say "hi"'
    kept = {r.review_id: r for r in
            read_source(spark, tmp_dir, "order_reviews", keep_empty_strings=True).collect()}
    assert kept["r2"].review_comment_title == "" and kept["r2"].review_score is None


def test_strict_delimited_keeps_quotes(spark, tmp_dir):
    _write(f"{tmp_dir}/category_translation/part.csv",
           'product_category_name,product_category_name_english\n"a",x\nb,"y, z"\n')
    rows = read_source(spark, tmp_dir, "category_translation", strict_delimited=True).collect()
    assert rows[0].product_category_name == '"a"'
    assert rows[1].product_category_name_english == '"y'  # embedded comma shifts columns


def test_csv_roundtrip_all_raw_tables(spark, tmp_dir, smoke_dir):
    raw = star_raw(spark, smoke_dir)
    for name, df in raw.items():
        export_csv(df, f"{tmp_dir}/csv/{name}", single_file=False)
    for name, df in raw.items():
        back = read_source(spark, f"{tmp_dir}/csv", name)
        assert back.schema.simpleString() == df.schema.simpleString()
        # CSV cannot tell '' from NULL; compare with empty text folded to NULL
        fold = [F.when(F.col(f.name) == "", None).otherwise(F.col(f.name)).alias(f.name)
                if f.dataType.simpleString() == "string" else F.col(f.name)
                for f in RAW_SCHEMAS[name].fields]
        a, b = df.select(*fold), back.select(*fold)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_land_all_skips_missing_and_counts(spark, tmp_dir, smoke_dir):
    raw = star_raw(spark, smoke_dir)
    src = f"{tmp_dir}/src"
    for name in ("orders", "customers"):
        export_csv(raw[name], f"{src}/{name}.csv", single_file=True)
    report = {r["tbl"]: r for r in land_all(spark, src, f"{tmp_dir}/wh")}
    assert report["orders"]["status"] == "ok" and report["orders"]["rows"] == 1500
    assert report["customers"]["rows"] == 150
    assert report["sellers"]["status"] == "skipped"
    counts = {r.tbl: r.cnt for r in row_counts(
        {"orders": read_table(spark, f"{tmp_dir}/wh", "orders")}).collect()}
    assert counts == {"orders": 1500}


def test_pipeline_export_register_and_idempotence(spark, tmp_dir, smoke_dir):
    root = f"{tmp_dir}/wh"
    res1 = run_pipeline(spark, root, star_dir=smoke_dir, out=f"{tmp_dir}/out",
                        etl_date="2026-01-01")
    assert [e["status"] for e in res1["export"]] == ["ok"] * len(MART_TABLES)
    first = {n: read_table(spark, root, n).collect() for n in MART_TABLES}
    run_pipeline(spark, root, star_dir=smoke_dir, etl_date="2026-01-01")
    for n in MART_TABLES:
        again = read_table(spark, root, n).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, first[n])), n
    # exported CSV is sorted in presentation order and complete
    gt = spark.read.option("header", True).csv(f"{tmp_dir}/out/gmv_trend").collect()
    assert len(gt) == 434 and [r.dt for r in gt] == sorted(r.dt for r in gt)
    # a failing table is reported, the others still export
    rep = run_export(spark, root, ["gmv_trend", "no_such_mart"], f"{tmp_dir}/out2")
    assert [r["status"] for r in rep] == ["ok", "failed"]
    tables = register_all(spark, root, "mf_test").collect()
    assert {"trade_detail", "gmv_trend"} <= {t.tableName for t in tables}
    assert spark.table("mf_test.gmv_trend").count() == 434
    assert preview(spark.table("mf_test.gmv_trend"), 3, "gmv_trend").count() == 3


def test_write_table_partitioned(spark, tmp_dir, smoke_dir):
    df = star_raw(spark, smoke_dir)["orders"]
    path = write_table(df, tmp_dir, "orders_by_status", partition_by=["order_status"])
    back = spark.read.parquet(path).filter(F.col("order_status") == "delivered")
    assert back.count() == df.filter(F.col("order_status") == "delivered").count()


def test_pipeline_quality_report_from_observed_metrics(spark, tmp_dir, smoke_dir):
    from martforge.plans.warehouse import Warehouse
    res = run_pipeline(spark, f"{tmp_dir}/wh", star_dir=smoke_dir, etl_date="2026-01-01",
                       quality=True, charts=True)
    assert "quality_report" in res["timings"] and "charts" in res["timings"]
    assert read_table(spark, f"{tmp_dir}/wh/charts", "gmv_daily_peak").count() == 434
    got = read_table(spark, f"{tmp_dir}/wh", "quality_report")
    exp = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01").quality_report()
    assert got.count() == 11
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_read_text_table_tab_delimited(spark, tmp_dir, smoke_dir):
    from martforge.plans.warehouse import Warehouse
    from martforge.sources.raw import read_text_table
    gt = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01").gmv_trend
    gt.write.mode("overwrite").option("sep", "\t").option("header", "false").csv(f"{tmp_dir}/gt")
    back = read_text_table(spark, f"{tmp_dir}/gt", "gmv_trend")
    assert back.schema.simpleString() == gt.schema.simpleString()
    assert back.exceptAll(gt).count() == 0 and gt.exceptAll(back).count() == 0


def test_landing_keeps_empty_text(spark, tmp_dir):
    _write(f"{tmp_dir}/src/category_translation.csv",
           "product_category_name,product_category_name_english\na,\n")
    rep = land_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/wh",
                   {"category_translation": "category_translation.csv"})
    assert rep[0]["status"] == "ok"
    row = read_table(spark, f"{tmp_dir}/wh", "category_translation").first()
    assert row.product_category_name_english == ""


def test_cli_builds_from_raw_csv(spark, tmp_dir, smoke_dir):
    import json
    import subprocess
    import sys
    raw = star_raw(spark, smoke_dir)
    for name, df in raw.items():
        export_csv(df, f"{tmp_dir}/csv/{name}", single_file=False)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "martforge.plans.pipeline", "--master", "local[2]",
                        "--raw-csv-dir", f"{tmp_dir}/csv", "--warehouse-dir", f"{tmp_dir}/wh",
                        "--output-dir", f"{tmp_dir}/out", "--etl-date", "2026-01-01",
                        "--quality"], capture_output=True, text=True, cwd=root, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    res = json.loads(r.stdout.strip().splitlines()[-1])
    assert {x["tbl"]: x["rows"] for x in res["landing"]}["order_items"] == 6000
    assert [e["status"] for e in res["export"]] == ["ok"] * len(MART_TABLES)
    assert read_table(spark, f"{tmp_dir}/wh", "quality_report").count() == 11


def test_state_matrix_adds_up_to_the_month(spark, smoke_dir):
    from martforge.operators.charts import region_month_matrix
    from martforge.plans.warehouse import Warehouse
    w = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01")
    month = w.region_sales_month
    want = {r.month_dt: r.gmv for r in month.groupBy("month_dt").agg(F.sum("gmv").alias("gmv")).collect()}
    for states in (None, ["NATION_1", "NATION_2"]):
        m = region_month_matrix(month, states)
        assert len(m.columns) == (27 if states is None else 4)
        got = {r[0]: sum(x for x in r[1:] if x is not None) for r in m.collect()}
        assert got == {k: v or 0 for k, v in want.items()}


def test_export_only_command_line(spark, tmp_dir, smoke_dir):
    from martforge.plans.pipeline import main
    row = spark.sql("SELECT '2020-01-01' AS dt, 1.00BD AS gmv, 1L AS order_cnt, 1L AS customer_cnt, "
                    "1.00BD AS avg_order_amt")
    from martforge.plans.sinks import write_table
    write_table(row, f"{tmp_dir}/wh", "gmv_trend")
    assert main(["--export-only", "--warehouse-dir", f"{tmp_dir}/wh", "--tables", "gmv_trend",
                 "--output-dir", f"{tmp_dir}/csv"]) == 0
    assert spark.read.csv(f"{tmp_dir}/csv/gmv_trend", header=True).count() == 1
    assert main(["--export-only", "--warehouse-db", "absent_db", "--tables", "gmv_trend",
                 "--output-dir", f"{tmp_dir}/csv2"]) == 1
