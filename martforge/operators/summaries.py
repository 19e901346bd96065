"""Summary layer: A-01 order-level dedupe and the six summaries T-02 ... T-07.

``payment_value_sum`` is an order-level figure repeated on every item row,
so every GMV figure first collapses the detail to one row per order (taking
``MAX``) and only then sums.

Two ways to get the order level:

* :func:`order_level` - the literal form: filter the detail and group it by
  ``(date, order_id, dims...)``.
* :func:`order_grain` + ``grain=`` - one shared pass: the detail is grouped
  once by the union of all the keys the summaries use, and each summary
  re-groups that (much smaller) table by its own keys. ``MAX`` of ``MAX`` is
  the ``MAX`` over the union, so this is exact whatever the key quality.
  Every key set contains ``order_id``, so when the detail arrives
  hash-partitioned on ``order_id`` neither step shuffles; only the final
  per-day aggregation does, after map-side partial aggregation.

Group labels are applied after grouping on the raw column, so a NULL and a
literal 'unknown' remain two rows, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import DELIVERED, label, present
from ..functions.money import ratio
from ..schemas import MONEY_ORDER, conform

DATE = "order_purchase_date"
GRAIN_KEYS = (DATE, "order_id", "customer_id", "customer_state", "customer_city",
              "payment_type")


def _delivered(detail: DataFrame, nonempty_date: bool) -> DataFrame:
    cond = (F.col("order_status") == DELIVERED) & F.col(DATE).isNotNull()
    if nonempty_date:
        cond = cond & (F.col(DATE) != "")
    return detail.filter(cond)


def order_level(detail: DataFrame, dims: Sequence[str], *,
                nonempty_date: bool = True) -> DataFrame:
    """A-01: delivered, dated orders, one row per ``(date, order_id, dims)``
    with ``pay_amt = MAX(payment_value_sum)``."""
    keys = [DATE, "order_id", *[d for d in dims if d not in (DATE, "order_id")]]
    return (_delivered(detail, nonempty_date)
            .groupBy(*keys).agg(F.max("payment_value_sum").alias("pay_amt")))


def order_grain(detail: DataFrame) -> DataFrame:
    """Shared order-level table over :data:`GRAIN_KEYS`. Keeps empty dates
    (the user summary counts them); the other summaries drop them."""
    return order_level(detail, GRAIN_KEYS[2:], nonempty_date=False)


def one_row_per_order(grain: DataFrame) -> bool:
    """True when the (written) order grain has one row per date and order; the
    summaries then need no regrouping. One shuffle instead of one each."""
    return grain.groupBy(DATE, "order_id").count().filter("count > 1").isEmpty()


def _orders(detail: DataFrame | None, grain: DataFrame | None, dims: Sequence[str],
            nonempty_date: bool = True, regroup: bool = True) -> DataFrame:
    if grain is None:
        return order_level(detail, dims, nonempty_date=nonempty_date)
    keys = [DATE, "order_id", *dims]
    src = grain.filter(F.col(DATE) != "") if nonempty_date else grain
    if not regroup:
        return src.select(*keys, "pay_amt")
    return src.groupBy(*keys).agg(F.max("pay_amt").alias("pay_amt"))


def _n() -> F.Column:
    return F.count(F.lit(1))


def gmv_day(detail: DataFrame | None = None, *, grain: DataFrame | None = None,
    regroup: bool = True) -> DataFrame:
    """T-02: per day - GMV, orders, distinct customers, average order value."""
    t = _orders(detail, grain, ["customer_id"], regroup=regroup)
    out = (t.groupBy(F.col(DATE).alias("dt"))
           .agg(F.sum("pay_amt").alias("gmv"),
                _n().alias("order_cnt"),
                F.count_distinct("customer_id").alias("customer_cnt"),
                ratio(F.sum("pay_amt"), _n(), 2, MONEY_ORDER).alias("avg_order_amt")))
    return conform(out, "gmv_day")


def product_sales(detail: DataFrame) -> DataFrame:
    """T-03: per product x day at item level (no order dedupe): item money,
    distinct orders, item rows, distinct buyers."""
    d = _delivered(detail, True).filter(F.col("product_id").isNotNull())
    out = (d.groupBy("product_id", "product_category_name_english", DATE)
           .agg(F.sum("item_total_amount").alias("sales_amt"),
                F.count_distinct("order_id").alias("order_cnt"),
                _n().alias("item_qty"),
                F.count_distinct("customer_id").alias("buyer_cnt"))
           .select("product_id", label("product_category_name_english"),
                   F.col(DATE).alias("dt"), "sales_amt", "order_cnt", "item_qty",
                   "buyer_cnt"))
    return conform(out, "product_sales")


def region_day(detail: DataFrame | None = None, *, grain: DataFrame | None = None,
    regroup: bool = True) -> DataFrame:
    """T-04: per state x day."""
    t = _orders(detail, grain, ["customer_id", "customer_state"], regroup=regroup)
    out = (t.groupBy("customer_state", DATE)
           .agg(F.sum("pay_amt").alias("gmv"), _n().alias("order_cnt"),
                F.count_distinct("customer_id").alias("customer_cnt"))
           .select(label("customer_state"), F.col(DATE).alias("dt"), "gmv",
                   "order_cnt", "customer_cnt"))
    return conform(out, "region_day")


def city_day(detail: DataFrame | None = None, *, grain: DataFrame | None = None,
    regroup: bool = True) -> DataFrame:
    """T-05: per city + state x day."""
    t = _orders(detail, grain, ["customer_id", "customer_city", "customer_state"], regroup=regroup)
    out = (t.groupBy("customer_city", "customer_state", DATE)
           .agg(F.sum("pay_amt").alias("gmv"), _n().alias("order_cnt"),
                F.count_distinct("customer_id").alias("customer_cnt"))
           .select(label("customer_city"), label("customer_state"),
                   F.col(DATE).alias("dt"), "gmv", "order_cnt", "customer_cnt"))
    return conform(out, "city_day")


def payment_type_day(detail: DataFrame | None = None, *,
                     grain: DataFrame | None = None,
    regroup: bool = True) -> DataFrame:
    """T-06: per payment type x day. Orders without payment form the
    'unknown' row with a NULL gmv."""
    t = _orders(detail, grain, ["payment_type"], regroup=regroup)
    out = (t.groupBy("payment_type", DATE)
           .agg(F.sum("pay_amt").alias("gmv"), _n().alias("order_cnt"))
           .select(label("payment_type"), F.col(DATE).alias("dt"), "gmv", "order_cnt"))
    return conform(out, "payment_type_day")


def user_order_summary(detail: DataFrame | None = None, *,
                       grain: DataFrame | None = None,
    regroup: bool = True) -> DataFrame:
    """T-07: per customer - last and first purchase date, distinct orders,
    paid total. Its guard differs from the other summaries on purpose: an
    empty date passes, a NULL customer does not."""
    t = _orders(detail, grain, ["customer_id"], nonempty_date=False, regroup=regroup)
    t = t.filter(F.col("customer_id").isNotNull())
    out = (t.groupBy("customer_id")
           .agg(F.max(DATE).alias("last_order_date"),
                F.min(DATE).alias("first_order_date"),
                F.count_distinct("order_id").alias("order_cnt"),
                F.sum("pay_amt").alias("total_amt")))
    return conform(out, "user_order_summary")
