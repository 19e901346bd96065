"""Chart datasets V-01 ... V-10: the data behind each dashboard chart.

Drawing is not done here; every function returns a DataFrame ready for a
plotting tool. Inputs are the marts (or summaries). The only windows are
partitioned ones whose partitions are bounded by construction (the payment
types of one month, the categories of the top-N mart).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import ABNORMAL_STATUSES, month_of
from ..functions.money import percent
from ..functions.ranking import order_spec, rank_all, top_k_per_group

CHART_TOP = 15
TOP_PER_CATEGORY = 3
CHANGE_TYPE = "decimal(12,2)"


def gmv_daily_peak(gmv_trend: DataFrame) -> DataFrame:
    """V-01: daily GMV with ``is_peak`` on the day(s) of maximum GMV. The
    maximum is a scalar subquery, evaluated once."""
    peak = gmv_trend.select(F.max("gmv")).scalar()
    return gmv_trend.select("dt", "gmv", "order_cnt",
                            F.coalesce(F.col("gmv") == peak, F.lit(False)).alias("is_peak"))


def gmv_month_over_month(gmv_month: DataFrame, start_month: str | None = None) -> DataFrame:
    """V-02: monthly GMV and its change over the previous month in percent.

    ``lag`` over the month series, written without a global window: the
    months are numbered with :func:`rank_all` and each month is joined to
    the one numbered just before it. The start filter applies after that, so
    the first shown month still has its predecessor's change."""
    months = rank_all(gmv_month.select("month_dt", "gmv", "order_cnt"),
                      [F.col("month_dt").asc_nulls_first()], rank_col="_i")
    prev = months.select((F.col("_i") + 1).alias("_i"), F.col("gmv").alias("prev_gmv"))
    out = (months.join(prev, "_i", "left")
           .withColumn("mom_pct",
                       F.round(F.try_divide((F.col("gmv") - F.col("prev_gmv")) * F.lit(100),
                                            F.col("prev_gmv")), 2).cast(CHANGE_TYPE))
           .select("month_dt", "gmv", "order_cnt", "prev_gmv", "mom_pct"))
    if start_month is not None:
        out = out.filter(F.col("month_dt") >= start_month)
    return out


def top_ranked(ranked_mart: DataFrame, n: int = CHART_TOP) -> DataFrame:
    """V-03 / V-04 / V-05: the first ``n`` rows of a ranked mart."""
    return ranked_mart.filter(F.col("rank_num") <= n)


def payment_share(payment_dist: DataFrame) -> DataFrame:
    """V-06: the payment-type share (pie chart data)."""
    return payment_dist.select("payment_type", "gmv", "gmv_pct")


def category_top_products(product_topn: DataFrame, k: int = TOP_PER_CATEGORY) -> DataFrame:
    """V-07: the best ``k`` products of each category, within the top-N
    product mart."""
    order = order_spec("sales_amt", ["product_id"])
    return top_k_per_group(product_topn, ["product_category_name_english"], order, k,
                           rank_col="category_rank") \
        .select("product_category_name_english", "category_rank", "product_id",
                "sales_amt", "rank_num")


def abnormal_orders_month(order_status_day: DataFrame,
                          statuses: Sequence[str] = ABNORMAL_STATUSES) -> DataFrame:
    """V-08: canceled / unavailable orders per month."""
    return (order_status_day.filter(F.col("order_status").isin(list(statuses)))
            .groupBy(month_of("dt").alias("month_dt"), "order_status")
            .agg(F.sum("order_cnt").alias("order_cnt")))


def region_month_matrix(region_sales_month: DataFrame,
                        states: Sequence[str] | None = None) -> DataFrame:
    """V-09: month x state GMV matrix. By default there is a column for every
    state in the data (a bounded collect of state names), so a row sums to its
    month. An explicit ``states`` list fixes the schema instead; what the
    other states sold is then added up in ``other``."""
    name = F.col("customer_state")
    if states is None:
        found = region_sales_month.select("customer_state").distinct().orderBy("customer_state")
        columns = [r[0] for r in found.collect()]
    else:
        columns = [*states, "other"]
        name = F.when(name.isin(list(states)), name).otherwise("other")
    out = (region_sales_month.select("month_dt", name.alias("customer_state"), "gmv")
           .groupBy("month_dt").pivot("customer_state", columns).agg(F.sum("gmv")))
    return out.select("month_dt", *[F.col(f"`{s}`").cast("decimal(14,2)").alias(s)
                                    for s in columns])


def payment_month_share(payment_type_month: DataFrame) -> DataFrame:
    """V-10: each payment type's share of its month's GMV (sums to 100 up to
    rounding). The window partition per month holds one row per payment
    type."""
    month_total = F.sum("gmv").over(Window.partitionBy("month_dt"))
    return payment_type_month.select(
        "month_dt", "payment_type", "gmv",
        percent(F.col("gmv"), month_total).alias("gmv_pct"))
