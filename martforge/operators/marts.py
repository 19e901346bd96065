"""Mart layer: the ten reporting tables T-08 ... T-17.

Marts read the summaries, never the detail (except the status monitor, which
must see every status). Roll-ups keep the reference's arithmetic on purpose:
monthly customer counts are sums of *daily* distinct counts, and category
order counts are sums of product-day counts.

Storage promises no row order; :data:`martforge.schemas.SORT_KEYS` holds the
presentation order the exporter applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import UNKNOWN, month_of, present
from ..functions.money import percent, ratio
from ..functions.ranking import order_spec, rank_all, top_n
from ..schemas import MONEY_ORDER, conform

PRODUCT_TOP_N = 100
CATEGORY_TOP_N = 50
CITY_TOP_N = 100


def gmv_trend(gmv_day: DataFrame) -> DataFrame:
    """T-08: the daily GMV series."""
    return conform(gmv_day, "gmv_trend")


def _product_totals(product_sales: DataFrame, keys: list[str]) -> DataFrame:
    return (product_sales.groupBy(*keys)
            .agg(F.sum("sales_amt").alias("sales_amt"),
                 F.sum("order_cnt").alias("order_cnt"),
                 F.sum("item_qty").alias("item_qty")))


def product_topn(product_sales: DataFrame, n: int = PRODUCT_TOP_N) -> DataFrame:
    """T-09: products ranked by total sales, top ``n``."""
    keys = ["product_id", "product_category_name_english"]
    ranked = top_n(_product_totals(product_sales, keys), order_spec("sales_amt", keys), n)
    return conform(ranked, "product_topn")


def _region_totals(region_day: DataFrame) -> DataFrame:
    return (region_day.groupBy("customer_state")
            .agg(F.sum("gmv").alias("gmv"),
                 F.sum("order_cnt").alias("order_cnt"),
                 F.sum("customer_cnt").alias("customer_cnt")))


def region_sales_rank(region_day: DataFrame) -> DataFrame:
    """T-10: every state ranked by GMV (no cut-off)."""
    ranked = rank_all(_region_totals(region_day), order_spec("gmv", ["customer_state"]))
    return conform(ranked, "region_sales_rank")


def order_status_day(detail: DataFrame) -> DataFrame:
    """T-11: distinct orders per day x status, every status (no delivered
    filter); dates must be present."""
    out = (detail.filter(present("order_purchase_date"))
           .groupBy("order_purchase_date", "order_status")
           .agg(F.count_distinct("order_id").alias("order_cnt"))
           .select(F.col("order_purchase_date").alias("dt"),
                   F.coalesce(F.col("order_status"), F.lit(UNKNOWN)).alias("order_status"),
                   "order_cnt"))
    return conform(out, "order_status_day")


def gmv_month(gmv_day: DataFrame) -> DataFrame:
    """T-12: monthly GMV; ``customer_cnt`` sums the daily distinct counts."""
    out = (gmv_day.groupBy(month_of("dt").alias("month_dt"))
           .agg(F.sum("gmv").alias("gmv"),
                F.sum("order_cnt").alias("order_cnt"),
                F.sum("customer_cnt").alias("customer_cnt"),
                ratio(F.sum("gmv"), F.sum("order_cnt"), 2, MONEY_ORDER).alias("avg_order_amt")))
    return conform(out, "gmv_month")


def region_sales_month(region_day: DataFrame) -> DataFrame:
    """T-13: state x month."""
    out = (region_day.groupBy(month_of("dt").alias("month_dt"), "customer_state")
           .agg(F.sum("gmv").alias("gmv"),
                F.sum("order_cnt").alias("order_cnt"),
                F.sum("customer_cnt").alias("customer_cnt")))
    return conform(out, "region_sales_month")


def payment_type_month(payment_type_day: DataFrame) -> DataFrame:
    """T-14: payment type x month."""
    out = (payment_type_day.groupBy(month_of("dt").alias("month_dt"), "payment_type")
           .agg(F.sum("gmv").alias("gmv"), F.sum("order_cnt").alias("order_cnt")))
    return conform(out, "payment_type_month")


def total_gmv(gmv_day: DataFrame):
    """``(SELECT SUM(gmv) FROM gmv_day)`` as a scalar-subquery column: Spark
    evaluates it once and inlines the value - no join at all."""
    return gmv_day.select(F.sum("gmv")).scalar()


def payment_dist(payment_type_day: DataFrame, gmv_day: DataFrame) -> DataFrame:
    """T-15: GMV share per payment type. The numerator comes from the
    payment-type summary, the denominator from the daily GMV summary; a zero
    or missing total gives a NULL share."""
    t = (payment_type_day.groupBy("payment_type")
         .agg(F.sum("gmv").alias("gmv"), F.sum("order_cnt").alias("order_cnt")))
    out = t.withColumn("gmv_pct", percent("gmv", total_gmv(gmv_day)))
    return conform(out, "payment_dist")


def category_topn(product_sales: DataFrame, n: int = CATEGORY_TOP_N) -> DataFrame:
    """T-16: categories ranked by sales, top ``n``."""
    keys = ["product_category_name_english"]
    ranked = top_n(_product_totals(product_sales, keys), order_spec("sales_amt", keys), n)
    return conform(ranked, "category_topn")


def city_sales(city_day: DataFrame, n: int = CITY_TOP_N) -> DataFrame:
    """T-17: cities ranked by GMV, top ``n``."""
    keys = ["customer_city", "customer_state"]
    totals = (city_day.groupBy(*keys)
              .agg(F.sum("gmv").alias("gmv"),
                   F.sum("order_cnt").alias("order_cnt"),
                   F.sum("customer_cnt").alias("customer_cnt")))
    ranked = top_n(totals, order_spec("gmv", keys), n)
    return conform(ranked, "city_sales")
