"""Data-quality checks Q-1 ... Q-8 on the detail table and its raw inputs.

Each check returns a DataFrame with the reference's column names. The
per-row flags are plain ``SUM(CASE WHEN ...)`` aggregates, so on an empty
input they are NULL (and ``COUNT(*)`` is 0), exactly like the SQL checks.

:func:`detail_profile` computes every single-pass metric over the detail in
one aggregation; :func:`profile_columns` exposes the same expressions so a
writer can collect them with ``observe`` while it writes the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import blank, flag_count
from ..functions.money import percent
from ..functions.skew import salted_join

PCT_TYPE = "decimal(5,2)"


def _no_payment() -> Column:
    return F.col("payment_type").isNull() & F.col("payment_value_sum").isNull()


def profile_columns() -> list[Column]:
    """All one-pass detail metrics as named aggregate expressions."""
    return [
        F.count(F.lit(1)).alias("total_cnt"),
        flag_count(blank("order_id")).alias("order_id_null_cnt"),
        flag_count(blank("customer_id")).alias("customer_id_null_cnt"),
        flag_count(blank("product_id")).alias("product_id_null_cnt"),
        flag_count(F.col("price") < 0).alias("price_negative_cnt"),
        flag_count(F.col("freight_value") < 0).alias("freight_negative_cnt"),
        flag_count(_no_payment()).alias("no_payment_cnt"),
    ]


def detail_profile(detail: DataFrame) -> DataFrame:
    return detail.agg(*profile_columns())


def source_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())


def row_count_check(items: DataFrame, detail: DataFrame) -> DataFrame:
    """Q-1: ``(source, row_count)`` for usable raw items and for the detail;
    expectation: detail <= items."""
    a = source_items(items).agg(F.count(F.lit(1)).alias("row_count")) \
        .select(F.lit("order_items").alias("source"), "row_count")
    b = detail.agg(F.count(F.lit(1)).alias("row_count")) \
        .select(F.lit("trade_detail").alias("source"), "row_count")
    return a.unionByName(b)


def duplicate_groups(detail: DataFrame, lazy: bool = False) -> DataFrame:
    """``HAVING COUNT(*) > 1`` over the detail grain.

    Nearly every row is a group of its own. When the detail is a ``lazy`` plan
    rather than a written table, the groups are held in tasks of their own, as
    many as the session has shuffle partitions, and not beside the sorts of the
    join that makes the detail."""
    if lazy:
        parts = int(detail.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        detail = detail.repartition(parts, "order_id", "order_item_id")
    return (detail.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def duplicate_check(detail: DataFrame, lazy: bool = False) -> DataFrame:
    """Q-2: number of ``(order_id, order_item_id)`` groups with more than one
    row; expectation 0."""
    return duplicate_groups(detail, lazy).agg(F.count(F.lit(1)).alias("duplicate_count"))


def null_check(detail: DataFrame) -> DataFrame:
    """Q-3: NULL-or-empty key counts and the row total; expectation 0,0,0,n."""
    return detail_profile(detail).select(
        "order_id_null_cnt", "customer_id_null_cnt", "product_id_null_cnt", "total_cnt")


def negative_amount_check(detail: DataFrame) -> DataFrame:
    """Q-4: negative price / freight rows; expectation 0, 0."""
    return detail_profile(detail).select("price_negative_cnt", "freight_negative_cnt")


def orphan_items(items: DataFrame, orders: DataFrame, hot: Sequence = ()) -> DataFrame:
    """J-06: raw items whose order does not exist (anti join); ``hot`` orders
    are salted."""
    return salted_join(items.filter(F.col("order_id").isNotNull()), orders.select("order_id"),
                       "order_id", "left_anti", hot)


def orphan_check(items: DataFrame, orders: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Q-5: ``items_without_order`` (informational)."""
    return orphan_items(items, orders, hot).agg(F.count(F.lit(1)).alias("items_without_order"))


def payment_coverage_check(detail: DataFrame) -> DataFrame:
    """Q-6: detail rows of orders without any payment, and their share."""
    return detail_profile(detail).select(
        "no_payment_cnt", "total_cnt",
        percent("no_payment_cnt", "total_cnt", dtype=None).cast(PCT_TYPE).alias("no_payment_pct"))


def status_distribution(detail: DataFrame) -> DataFrame:
    """Q-7: item rows per order status (presentation: by cnt descending)."""
    return detail.groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt"))


# The checks of the combined report with their expectations.
# (check, metric, expected text, rule) - rule None means informational.
REPORT_ROWS = [
    ("row_counts", "source_rows", None, None),
    ("row_counts", "detail_rows", "<= source_rows", "le_source"),
    ("duplicates", "duplicate_count", "0", "zero"),
    ("nulls", "order_id_null_cnt", "0", "zero"),
    ("nulls", "customer_id_null_cnt", "0", "zero"),
    ("nulls", "product_id_null_cnt", "0", "zero"),
    ("negative_amounts", "price_negative_cnt", "0", "zero"),
    ("negative_amounts", "freight_negative_cnt", "0", "zero"),
    ("orphans", "items_without_order", None, None),
    ("payment_coverage", "no_payment_cnt", None, None),
    ("payment_coverage", "no_payment_pct", None, None),
]

REPORT_VALUE_TYPE = "decimal(20,2)"


PROFILE_SCHEMA = ("total_cnt long, order_id_null_cnt long, customer_id_null_cnt long, "
                  "product_id_null_cnt long, price_negative_cnt long, "
                  "freight_negative_cnt long, no_payment_cnt long")


def profile_from_metrics(spark, metrics: dict) -> DataFrame:
    """The one-row profile from metrics observed while writing the detail."""
    names = [c.split()[0] for c in PROFILE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(metrics.get(n) for n in names)], PROFILE_SCHEMA)


def quality_report(items: DataFrame, orders: DataFrame, detail: DataFrame,
                   profile: DataFrame | None = None, hot: Sequence = (),
                   lazy: bool = False) -> DataFrame:
    """Q-8: Q-1 ... Q-6 as rows ``(check, metric, value, expected, passed)``.

    One aggregation pass over the detail - or none, when ``profile`` carries
    the metrics observed while the detail was written; the three other
    figures (usable raw items, duplicate groups, orphan items) join it as
    scalar subqueries, each evaluated once. ``passed`` is NULL for
    informational metrics."""
    if profile is None:
        profile = detail_profile(detail)
    wide = profile.select(
        "*",
        source_items(items).select(F.count(F.lit(1))).scalar().alias("source_rows"),
        duplicate_check(detail, lazy).scalar().alias("duplicate_count"),
        orphan_check(items, orders, hot).scalar().alias("items_without_order"),
    ).withColumns({
        "detail_rows": F.col("total_cnt"),
        "no_payment_pct": percent("no_payment_cnt", "total_cnt", dtype=None).cast(PCT_TYPE),
    })
    rows = []
    for check, metric, expected, rule in REPORT_ROWS:
        value = F.col(metric).cast(REPORT_VALUE_TYPE)
        if rule == "zero":
            passed = F.coalesce(F.col(metric), F.lit(0)) == 0
        elif rule == "le_source":
            passed = F.col("detail_rows") <= F.col("source_rows")
        else:
            passed = F.lit(None).cast("boolean")
        rows.append(F.struct(F.lit(check).alias("check"), F.lit(metric).alias("metric"),
                             value.alias("value"),
                             F.lit(expected).cast("string").alias("expected"),
                             passed.alias("passed")))
    return wide.select(F.inline(F.array(*rows)))
