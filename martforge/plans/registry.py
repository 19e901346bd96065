"""Named queries over a star-schema test directory.

Each entry takes ``(spark, sf_dir)``, adapts the whole star schema into the
nine raw tables and returns one layer's DataFrame as a single lazy plan.
The correctness oracle beside the entry file holds the matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import charts as C
from ..operators import quality as Q
from ..operators import summaries as S
from ..schemas import schema_of
from ..session import scratch_path
from ..sources.landing import land_all, landing_report, row_counts
from ..sources.raw import read_source, read_table, reject_report
from ..sources.records import read_records
from ..sources.text_layer import read_text_table, write_text_table
from .sinks import (catalog_report, export_csv, export_report, register_all, run_export,
                    write_table)
from .warehouse import Warehouse

# Parameters of the registered queries.
ETL_DATE = "2026-01-01"
START_MONTH = "1994-01"

# Raw tables whose CSV export and import are registered as queries.
CSV_TABLES = ("orders", "order_items", "order_payments", "customers", "category_translation")

QueryFn = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_star(spark, sf_dir, etl_date=ETL_DATE)


def _layer(attr: str) -> QueryFn:
    return lambda spark, d: getattr(_wh(spark, d), attr)


def _raw_items_orders(fn):
    def q(spark, d):
        w = _wh(spark, d)
        return fn(w.raw["order_items"], w.raw["orders"])
    return q


def _on_detail(fn):
    return lambda spark, d: fn(_wh(spark, d).detail)


def _csv_roundtrip(name: str) -> QueryFn:
    """A raw table exported as CSV and read back with its declared schema."""
    def q(spark, d):
        path = scratch_path(spark, f"csv-{name}")
        export_csv(_wh(spark, d).raw[name], path, single_file=False)
        return read_source(spark, "", name, path=path, keep_empty_strings=True)
    return q


def _published(spark: SparkSession, d: str) -> DataFrame:
    """A mart read through its version pointer, after a smaller first version."""
    root, mart = scratch_path(spark, "published"), _wh(spark, d).payment_type_month
    write_table(mart.filter("month_dt < '1995'"), root, "payment_type_month")
    write_table(mart, root, "payment_type_month")
    return read_table(spark, root, "payment_type_month")


def _single_file(spark: SparkSession, d: str) -> DataFrame:
    """A mart exported as one sorted file and read back with its line numbers."""
    name, path = "order_status_day", scratch_path(spark, "single-file")
    export_csv(_wh(spark, d).order_status_day, path, name=name)
    records = read_records(spark, f"{path}/part-00000.csv", number="line_no")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_of(name).fields)
    return records.select("line_no", F.from_csv("record", fields).alias("r")).select("line_no", "r.*")


# Texts are exported whole: quotes doubled, white space kept.
TEXT_OPTIONS = {"escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
                "ignoreTrailingWhiteSpace": "false"}


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with line breaks, exported as one file and read back in parallel."""
    path = scratch_path(spark, "reviews")
    export_csv(_wh(spark, d).raw["order_reviews"], path, **TEXT_OPTIONS)
    return read_source(spark, "", "order_reviews", path=path, keep_empty_strings=True)


def damaged_items(items: DataFrame) -> DataFrame:
    """The items as text, some of whose numbers do not parse (fixed rules on the order key)."""
    order = F.substring("order_id", 2, 20).cast("long")
    text = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    return text.withColumns({
        "order_item_id": F.when(order % 17 == 0, F.concat(F.lit("x"), "order_item_id")).otherwise(F.col("order_item_id")),
        "price": F.when(order % 23 == 0, F.lit("n/a")).otherwise(F.col("price")),
        "freight_value": F.when(order % 29 == 0, F.lit("1.2.3")).otherwise(F.col("freight_value"))})


def _rejects(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    export_csv(damaged_items(_wh(spark, d).raw["order_items"]), path, single_file=False)
    return reject_report(read_source(spark, "", "order_items", path=path, rejects=True))


def _text_layer(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "text-layer")
    write_text_table(_wh(spark, d).detail, root, "trade_detail")
    return read_text_table(spark, f"{root}/trade_detail", "trade_detail")


def _landing_status(spark: SparkSession, d: str) -> DataFrame:
    """Landing of four raw files, one of them damaged, one with line breaks and one absent."""
    src, raw = scratch_path(spark, "to-land"), _wh(spark, d).raw
    export_csv(raw["customers"], f"{src}/customers", single_file=False)
    export_csv(damaged_items(raw["order_items"]), f"{src}/order_items", single_file=False)
    export_csv(raw["order_reviews"], f"{src}/order_reviews", **TEXT_OPTIONS)
    names = ("customers", "order_items", "order_reviews", "sellers")
    return landing_report(spark, land_all(spark, src, scratch_path(spark, "landed"), {n: n for n in names}))


def _wh_stored(spark: SparkSession, d: str) -> Warehouse:
    """A warehouse whose order grain is computed once and written, for queries
    that write several marts made from it."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        if name != "_order_grain":
            return df
        path = scratch_path(spark, "order-grain")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return Warehouse.from_star(spark, d, etl_date=ETL_DATE, materialize=keep)


def _export_status(spark: SparkSession, d: str) -> DataFrame:
    """Exports of three marts and of a table that does not exist."""
    root, wh = scratch_path(spark, "marts"), _wh_stored(spark, d)
    names = ("gmv_month", "payment_dist", "region_sales_month")
    for name in names:
        write_table(getattr(wh, name), root, name)
    report = run_export(spark, root, [*names, "no_such_mart"], scratch_path(spark, "exported"))
    return export_report(spark, report).drop("error")


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    """Two marts registered in a database: their rows and their columns as
    the catalog describes them."""
    root, wh, db = scratch_path(spark, "catalog"), _wh_stored(spark, d), "martforge_catalog_query"
    names = ("category_topn", "payment_dist")
    for name in names:
        write_table(getattr(wh, name), root, name)
    register_all(spark, root, db, names)
    report = catalog_report(spark, db, names)
    counted = row_counts({name: read_table(spark, None, f"{db}.{name}") for name in names})
    return report.join(counted, "tbl").withColumnRenamed("cnt", "table_rows")


#: Queries that write files while they are built.
WRITING: dict[str, QueryFn] = {
    "reviews_roundtrip": _reviews, "csv_rejects": _rejects, "text_layer_trade_detail": _text_layer,
    "single_file_order_status_day": _single_file, "published_payment_type_month": _published,
    "landing_status": _landing_status, "export_status": _export_status, "catalog_columns": _catalog,
}


def build_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "payment_rollup": _layer("payment_rollup"),
        "trade_detail": _layer("detail"),
        "order_level": _on_detail(lambda det: S.order_level(det, ["customer_id"])),
    }
    for name in ("gmv_day", "product_sales", "region_day", "city_day", "payment_type_day",
                 "user_order_summary", "gmv_trend", "product_topn", "region_sales_rank",
                 "order_status_day", "gmv_month", "region_sales_month", "payment_type_month",
                 "payment_dist", "category_topn", "city_sales"):
        q[name] = _layer(name)
    q.update({
        "dq_row_counts": lambda s, d: Q.row_count_check(
            _wh(s, d).raw["order_items"], _wh(s, d).detail),
        "dq_duplicates": _on_detail(lambda det: Q.duplicate_check(det, lazy=True)),
        "dq_duplicate_groups": _on_detail(lambda det: Q.duplicate_groups(det, lazy=True)),
        "dq_nulls": _on_detail(Q.null_check),
        "dq_negative_amounts": _on_detail(Q.negative_amount_check),
        "dq_orphan_items": _raw_items_orders(Q.orphan_check),
        "anti_join_orphans": _raw_items_orders(Q.orphan_items),
        "dq_payment_coverage": _on_detail(Q.payment_coverage_check),
        "dq_status_dist": _on_detail(Q.status_distribution),
        "dq_report": lambda s, d: _wh(s, d).quality_report(),
        "raw_row_counts": lambda s, d: _wh(s, d).raw_row_counts(),
        "chart_gmv_daily_peak": lambda s, d: C.gmv_daily_peak(_wh(s, d).gmv_trend),
        "chart_gmv_mom": lambda s, d: C.gmv_month_over_month(
            _wh(s, d).gmv_month, START_MONTH),
        "chart_region_top15": lambda s, d: C.top_ranked(_wh(s, d).region_sales_rank),
        "chart_category_top15": lambda s, d: C.top_ranked(_wh(s, d).category_topn),
        "chart_city_top15": lambda s, d: C.top_ranked(_wh(s, d).city_sales),
        "chart_payment_share": lambda s, d: C.payment_share(_wh(s, d).payment_dist),
        "chart_category_top3": lambda s, d: C.category_top_products(_wh(s, d).product_topn),
        "chart_abnormal_month": lambda s, d: C.abnormal_orders_month(_wh(s, d).order_status_day),
        "chart_region_month_matrix": lambda s, d: C.region_month_matrix(
            _wh(s, d).region_sales_month),
        "chart_payment_month_share": lambda s, d: C.payment_month_share(
            _wh(s, d).payment_type_month),
    })
    for name in CSV_TABLES:
        q[f"csv_roundtrip_{name}"] = _csv_roundtrip(name)
    q.update(WRITING)
    return q
