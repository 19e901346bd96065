"""Detail layer: payment rollup (T-00) and the trade-detail wide table (T-01).

Grain of ``trade_detail``: one row per order item that has an order with a
customer. Payments are rolled up per order *before* the join, so a
multi-payment order never multiplies its items.

Join order, chosen for large inputs and hot keys (any single order,
customer, product or category may hold a large share of the rows):

1. ``products x translation`` on the product dimension, not on the items, so
   a hot category never funnels item rows into one shuffle partition.
2. ``items x products`` on ``product_id``.
3. ``orders x payment rollup`` on ``order_id`` - both sides carry at most one
   row per order, so this join cannot be skewed; the rollup is already
   partitioned on ``order_id`` by its own aggregation.
4. ``... x customers`` on ``customer_id`` - still at order grain, several
   times smaller than the items.
5. ``items x order header`` on ``order_id``.

Whether a side is broadcast is left to the optimizer and adaptive execution,
which know its size in bytes. Keys known to be hot (``hot``: column name ->
values, found by the pipeline with :func:`martforge.functions.skew.hot_keys`)
are salted in joins 2 and 5; each input is still scanned and joined once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import day_of
from ..functions.money import zero_if_null
from ..functions.skew import salted_join
from ..schemas import MONEY_ITEM, conform


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Per order: the type of the first payment (lowest sequence; ties go to
    the smaller type, as a struct minimum orders them) and the paid total."""
    first = F.min(F.struct(F.col("payment_sequential").alias("seq"),
                           F.col("payment_type").alias("type")))
    return (payments.groupBy("order_id")
            .agg(first["type"].alias("payment_type"),
                 F.sum("payment_value").cast("decimal(12,2)").alias("payment_value_sum")))


def _etl_date(etl_date: str | _dt.date | Column | None) -> Column:
    if etl_date is None:
        return F.current_date().cast("string")
    if isinstance(etl_date, Column):
        return etl_date.cast("string")
    return F.lit(str(etl_date))


def product_dimension(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category (snowflake flattened once)."""
    tr = translation.select("product_category_name", "product_category_name_english")
    return (products.select("product_id", "product_category_name", "product_weight_g")
            .join(tr, "product_category_name", "left"))


def trade_detail(items: DataFrame, orders: DataFrame, payments: DataFrame,
                 customers: DataFrame, products: DataFrame, translation: DataFrame,
                 etl_date: str | _dt.date | Column | None = None,
                 hot: Mapping[str, Sequence] | None = None) -> DataFrame:
    hot = hot or {}
    it = (items.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
          .select("order_id", "order_item_id", "product_id", "seller_id",
                  "price", "freight_value"))
    od = (orders.filter(F.col("customer_id").isNotNull())
          .select("order_id", "customer_id", "order_status", "order_purchase_timestamp"))
    cu = customers.select("customer_id", "customer_city", "customer_state")

    items_p = salted_join(it, product_dimension(products, translation), "product_id", "left",
                          hot.get("product_id", ()))
    header = (od.join(payment_rollup(payments), "order_id", "left")
                .join(cu, "customer_id", "left"))
    joined = salted_join(items_p, header, "order_id", "inner", hot.get("order_id", ()))
    price = zero_if_null("price", MONEY_ITEM)
    freight = zero_if_null("freight_value", MONEY_ITEM)
    out = joined.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        day_of("order_purchase_timestamp").alias("order_purchase_date"),
        "order_item_id", "product_id", "seller_id",
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("item_total_amount"),
        "payment_type", "payment_value_sum",
        "customer_city", "customer_state",
        "product_category_name", "product_category_name_english", "product_weight_g",
        _etl_date(etl_date).alias("etl_date"),
    )
    return conform(out, "trade_detail")


def trade_detail_from(raw: dict[str, DataFrame], etl_date=None,
                      hot: Mapping[str, Sequence] | None = None) -> DataFrame:
    """:func:`trade_detail` over a dict of the nine raw tables."""
    return trade_detail(raw["order_items"], raw["orders"], raw["order_payments"],
                        raw["customers"], raw["products"], raw["category_translation"],
                        etl_date=etl_date, hot=hot)
