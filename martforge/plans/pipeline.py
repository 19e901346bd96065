"""Full build (L-09): raw -> detail -> summaries -> marts -> CSV export.

Each layer is written to the warehouse folder and read back before the next
layer uses it. That is the lineage cut: a lost executor only recomputes the
stage it was in, never the layers below, and every consumer of a layer
(seven of the detail, for example) scans compact Parquet with column pruning
and pushed-down filters instead of re-running the joins.

The shared order-level table is an internal intermediate; it goes to the
cluster's checkpoint folder (``spark.checkpoint.dir``), not to the warehouse.

Usage::

    python -m martforge.plans.pipeline --raw-dir RAW --warehouse-dir WH \
        [--output-dir CSV] [--tables gmv_trend,...] [--etl-date 2024-01-31]
    python -m martforge.plans.pipeline --star-dir /root/testdata/sf0.1 --warehouse-dir WH
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import quality as Q
from ..functions.skew import frequent_keys
from ..schemas import MART_TABLES, RAW_TABLES, SUMMARY_TABLES
from ..session import get_session, scratch_path
from ..sources.bucketed import default_buckets, read_bucketed, write_bucketed
from ..sources.landing import ORDER_TABLES, land_all
from ..sources.raw import read_sources, read_table
from ..sources.star import star_raw
from ..storage import current_path
from .sinks import run_export, table_path, write_table
from .warehouse import Warehouse


# The raw tables that the build reads; the others may be missing.
READ_TABLES = ("orders", "order_items", "order_payments", "customers", "products",
               "category_translation")

def materializer(spark: SparkSession, root: str, timings: dict | None = None,
                 partition_detail_by: Sequence[str] = (),
                 observations: dict[str, tuple[Observation, list]] | None = None,
                 bucket_detail: bool = False):
    """``materialize`` hook: write the table and hand back a fresh read of it.
    Names starting with ``_`` are intermediates and go to the checkpoint
    folder. ``observations`` maps a table name to metrics collected during
    its write (no extra pass). With ``bucket_detail`` the detail is bucketed by
    order, so that order-level passes over it need no exchange."""

    def mat(df: DataFrame, name: str) -> DataFrame:
        t0 = time.perf_counter()
        if observations and name in observations:
            obs, cols = observations[name]
            df = df.observe(obs, *cols)
        if name.startswith("_"):
            path = scratch_path(spark, name.lstrip("_"))
            df.write.mode("overwrite").parquet(path)
            out = spark.read.parquet(path)
        elif name == "trade_detail" and bucket_detail:
            write_bucketed(df, root, name, "order_id")
            out = read_bucketed(spark, root, name)
        else:
            parts = partition_detail_by if name == "trade_detail" else ()
            write_table(df, root, name, partition_by=parts)
            out = read_table(spark, root, name)
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)
        return out

    return mat


def run_pipeline(spark: SparkSession, root: str, *, raw: dict[str, DataFrame] | None = None,
                 raw_dir: str | None = None, star_dir: str | None = None,
                 out: str | None = None, tables: Sequence[str] | None = None,
                 etl_date=None, csv_options: dict | None = None,
                 parallel_jobs: int = 8, quality: bool = False,
                 charts: bool = False, partition_detail_by: Sequence[str] = ()) -> dict:
    """Build every layer into ``root``; optionally export marts to ``out``.

    Raw input is one of: ``raw`` (nine DataFrames), ``raw_dir`` (landed
    Parquet folders, or CSV when ``csv_options`` is given), ``star_dir``
    (star-schema test tables). ``parallel_jobs`` caps how many tables of
    one layer are written at the same time. ``quality`` also writes the
    Q-8 report table, its detail metrics observed during the detail write;
    ``charts`` writes the ten chart datasets under ``root/charts``. Returns
    timings and the export report."""
    bucketed = False
    if raw is None:
        if star_dir:
            raw = star_raw(spark, star_dir)
        elif raw_dir and csv_options is not None:
            # an empty text field is '' on every way in, as in landing
            raw = read_sources(spark, raw_dir, **{"keep_empty_strings": True, **csv_options})
        elif raw_dir:
            raw = {n: read_table(spark, raw_dir, n) for n in READ_TABLES}
            bucketed = True
        else:
            raise ValueError("give raw, raw_dir or star_dir")
    timings: dict[str, float] = {}
    observed = {"trade_detail": (Observation("detail_profile"), Q.profile_columns())}
    t0 = time.perf_counter()
    hot = frequent_keys(raw["order_items"], ("order_id", "product_id"))
    timings["_hot_keys"] = round(time.perf_counter() - t0, 3)
    if bucketed and not hot["order_id"]:  # landed with buckets: joined on the order without an exchange
        raw |= {n: read_bucketed(spark, raw_dir, n) for n in ORDER_TABLES}
    # a hot order would be one task's bucket; a partitioned detail keeps its folders
    bucket_detail = not hot["order_id"] and not partition_detail_by
    wh = Warehouse(raw, etl_date=etl_date, hot=hot, materialize=materializer(
        spark, root, timings, partition_detail_by, observed, bucket_detail))
    # Layer by layer: the tables of one layer only depend on the layers
    # below, so their writes go to Spark as concurrent jobs.
    layers = [["detail"], ["grain"], ["regroup"], list(SUMMARY_TABLES), list(MART_TABLES)]
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        for layer in layers:
            list(pool.map(lambda n: getattr(wh, n), layer))
    timings["total"] = round(time.perf_counter() - t0, 3)
    if charts:
        t1 = time.perf_counter()
        chart_root = table_path(root, "charts")
        with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
            list(pool.map(lambda kv: write_table(kv[1], chart_root, kv[0]),
                          wh.charts().items()))
        timings["charts"] = round(time.perf_counter() - t1, 3)
    if quality:
        t1 = time.perf_counter()
        profile = Q.profile_from_metrics(spark, observed["trade_detail"][0].get)
        report = Q.quality_report(raw["order_items"], raw["orders"], wh.detail, profile,
                                  hot["order_id"])
        write_table(report, root, "quality_report")
        timings["quality_report"] = round(time.perf_counter() - t1, 3)
    result = {"root": root, "timings": timings,
              "tables": {n: current_path(spark, root, n) for n in
                         ("trade_detail", *SUMMARY_TABLES, *MART_TABLES)}}
    if out:
        result["export"] = run_export(spark, root, tables, out)
    return result


def main(argv: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Build the warehouse and export the marts.")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--raw-dir", help="folder of landed raw tables (Parquet)")
    src.add_argument("--raw-csv-dir", help="folder of raw CSV tables, one file or folder per "
                     "table name; landed as Parquet under <warehouse-dir>/raw first")
    src.add_argument("--star-dir", help="star-schema test tables")
    p.add_argument("--warehouse-dir", help="folder of the warehouse tables")
    p.add_argument("--warehouse-db", help="export only: read the marts from this database")
    p.add_argument("--export-only", action="store_true",
                   help="export finished marts of --warehouse-dir or --warehouse-db")
    p.add_argument("--file-map", default="", help="table=file pairs under --raw-csv-dir, "
                   "comma-separated (default: the table names)")
    p.add_argument("--bucket-raw", action="store_true", help="land orders, items and payments "
                   "bucketed by order (not for data with an order of very many rows)")
    p.add_argument("--partition-detail-by", default="", help="comma-separated columns")
    p.add_argument("--output-dir", help="CSV export folder (skip export when absent)")
    p.add_argument("--tables", default="", help="comma-separated marts to export")
    p.add_argument("--etl-date", default=None)
    p.add_argument("--master", default=None)
    p.add_argument("--quality", action="store_true", help="also write the quality report")
    p.add_argument("--charts", action="store_true", help="also write the chart datasets")
    a = p.parse_args(argv)
    tables = [t for t in a.tables.split(",") if t.strip()]
    if a.export_only or a.warehouse_db:
        if not a.output_dir or not (a.warehouse_dir or a.warehouse_db):
            p.error("an export needs --output-dir and --warehouse-dir or --warehouse-db")
        report = run_export(get_session(a.master), None if a.warehouse_db else a.warehouse_dir,
                            tables, a.output_dir, db=a.warehouse_db)
        print(json.dumps({"export": report}, default=str))
        return int(bool(report) and all(e["status"] != "ok" for e in report))
    if not a.warehouse_dir or not (a.raw_dir or a.raw_csv_dir or a.star_dir):
        p.error("a build needs --warehouse-dir and one of --raw-dir, --raw-csv-dir, --star-dir")
    spark = get_session(a.master)
    raw_dir, landing = a.raw_dir, None
    if a.raw_csv_dir:
        # land the raw CSV once as typed Parquet (the raw layer), then build
        # from it: later passes read columnar data, counts come from metadata
        raw_dir = table_path(a.warehouse_dir, "raw")
        landing = land_all(spark, a.raw_csv_dir, raw_dir, {
            **{n: n for n in RAW_TABLES},
            **dict(pair.split("=", 1) for pair in a.file_map.split(",") if pair.strip())},
            buckets=default_buckets(spark) if a.bucket_raw else None)
        # a missing table that nothing reads is reported and skipped
        missing = [r["tbl"] for r in landing if r["status"] != "ok" and r["tbl"] in READ_TABLES]
        if missing:
            print(json.dumps({"landing": landing}, default=str))
            return 1
    res = run_pipeline(
        spark, a.warehouse_dir, raw_dir=raw_dir, star_dir=a.star_dir,
        out=a.output_dir, tables=tables,
        partition_detail_by=[c for c in a.partition_detail_by.split(",") if c.strip()],
        etl_date=a.etl_date, quality=a.quality, charts=a.charts)
    if landing is not None:
        res["landing"] = landing
    print(json.dumps(res, default=str))
    exports = res.get("export") or []
    if exports and all(e["status"] != "ok" for e in exports):
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
