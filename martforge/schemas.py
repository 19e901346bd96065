"""Table contracts: the nine raw schemas and the seventeen derived ones.

Every table in the warehouse has an explicit schema (never inferred). The
derived schemas are the output contract: column names, order and types are
fixed, and :func:`conform` casts a frame onto them. Column comments travel as
``StructField`` metadata so a registered table can show them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DoubleType()
MONEY_ITEM = T.DecimalType(10, 2)
MONEY_ORDER = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(14, 2)
PCT = T.DecimalType(5, 2)


def _struct(*fields: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, True, {"comment": c}) for n, t, c in fields]
    )


# --------------------------------------------------------------------------
# Raw layer: nine landed tables (comma CSV with one header line at the edge).
# --------------------------------------------------------------------------
RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": _struct(
        ("order_id", S, "order key"),
        ("customer_id", S, "customer key"),
        ("order_status", S, "delivered / shipped / canceled / unavailable ..."),
        ("order_purchase_timestamp", S, "purchase time, yyyy-MM-dd HH:mm:ss text"),
        ("order_approved_at", S, "approval time"),
        ("order_delivered_carrier_date", S, "handed to carrier"),
        ("order_delivered_customer_date", S, "received by customer"),
        ("order_estimated_delivery_date", S, "estimated delivery"),
    ),
    "order_items": _struct(
        ("order_id", S, "order key"),
        ("order_item_id", I, "item sequence inside the order"),
        ("product_id", S, "product key"),
        ("seller_id", S, "seller key"),
        ("shipping_limit_date", S, "shipping deadline"),
        ("price", MONEY_ITEM, "item price"),
        ("freight_value", MONEY_ITEM, "freight charged for the item"),
    ),
    "order_payments": _struct(
        ("order_id", S, "order key"),
        ("payment_sequential", I, "payment sequence inside the order"),
        ("payment_type", S, "credit_card / boleto / voucher / debit_card ..."),
        ("payment_installments", I, "number of installments"),
        ("payment_value", MONEY_ORDER, "amount of this payment"),
    ),
    "customers": _struct(
        ("customer_id", S, "customer key (one per order)"),
        ("customer_unique_id", S, "person behind the customer key"),
        ("customer_zip_code_prefix", I, "zip prefix"),
        ("customer_city", S, "city"),
        ("customer_state", S, "state"),
    ),
    "products": _struct(
        ("product_id", S, "product key"),
        ("product_category_name", S, "category in the source language"),
        ("product_name_lenght", D, "name length (source spelling kept)"),
        ("product_description_lenght", D, "description length (source spelling kept)"),
        ("product_photos_qty", D, "photo count"),
        ("product_weight_g", D, "weight in grams"),
        ("product_length_cm", D, "length"),
        ("product_height_cm", D, "height"),
        ("product_width_cm", D, "width"),
    ),
    "sellers": _struct(
        ("seller_id", S, "seller key"),
        ("seller_zip_code_prefix", I, "zip prefix"),
        ("seller_city", S, "city"),
        ("seller_state", S, "state"),
    ),
    "order_reviews": _struct(
        ("review_id", S, "review key"),
        ("order_id", S, "order key"),
        ("review_score", I, "score 1..5"),
        ("review_comment_title", S, "title"),
        ("review_comment_message", S, "free text, may span lines"),
        ("review_creation_date", S, "created"),
        ("review_answer_timestamp", S, "answered"),
    ),
    "geolocation": _struct(
        ("geolocation_zip_code_prefix", I, "zip prefix"),
        ("geolocation_lat", D, "latitude"),
        ("geolocation_lng", D, "longitude"),
        ("geolocation_city", S, "city"),
        ("geolocation_state", S, "state"),
    ),
    "category_translation": _struct(
        ("product_category_name", S, "category in the source language"),
        ("product_category_name_english", S, "category in English"),
    ),
}

RAW_TABLES: tuple[str, ...] = tuple(RAW_SCHEMAS)

# --------------------------------------------------------------------------
# Detail, summary and mart contracts.
# --------------------------------------------------------------------------
DERIVED_SCHEMAS: dict[str, T.StructType] = {
    "trade_detail": _struct(
        ("order_id", S, "order key"),
        ("customer_id", S, "customer key"),
        ("order_status", S, "order status"),
        ("order_purchase_timestamp", S, "purchase time text"),
        ("order_purchase_date", S, "first 10 chars of the purchase time"),
        ("order_item_id", I, "item sequence"),
        ("product_id", S, "product key"),
        ("seller_id", S, "seller key"),
        ("price", MONEY_ITEM, "price, NULL read as 0"),
        ("freight_value", MONEY_ITEM, "freight, NULL read as 0"),
        ("item_total_amount", MONEY_ITEM, "price + freight"),
        ("payment_type", S, "type of the first payment of the order"),
        ("payment_value_sum", MONEY_ORDER, "order-level paid total, repeated per item"),
        ("customer_city", S, "customer city"),
        ("customer_state", S, "customer state"),
        ("product_category_name", S, "category, source language"),
        ("product_category_name_english", S, "category, English"),
        ("product_weight_g", D, "weight in grams"),
        ("etl_date", S, "build date"),
    ),
    "gmv_day": _struct(
        ("dt", S, "yyyy-MM-dd"),
        ("gmv", MONEY_SUM, "paid total of delivered orders"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "distinct customers"),
        ("avg_order_amt", MONEY_ORDER, "gmv / orders"),
    ),
    "product_sales": _struct(
        ("product_id", S, "product key"),
        ("product_category_name_english", S, "category label"),
        ("dt", S, "yyyy-MM-dd"),
        ("sales_amt", MONEY_SUM, "sum of item_total_amount"),
        ("order_cnt", L, "distinct orders"),
        ("item_qty", L, "item rows"),
        ("buyer_cnt", L, "distinct customers"),
    ),
    "region_day": _struct(
        ("customer_state", S, "state label"),
        ("dt", S, "yyyy-MM-dd"),
        ("gmv", MONEY_SUM, "paid total"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "distinct customers"),
    ),
    "city_day": _struct(
        ("customer_city", S, "city label"),
        ("customer_state", S, "state label"),
        ("dt", S, "yyyy-MM-dd"),
        ("gmv", MONEY_SUM, "paid total"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "distinct customers"),
    ),
    "payment_type_day": _struct(
        ("payment_type", S, "payment type label"),
        ("dt", S, "yyyy-MM-dd"),
        ("gmv", MONEY_SUM, "paid total"),
        ("order_cnt", L, "orders"),
    ),
    "user_order_summary": _struct(
        ("customer_id", S, "customer key"),
        ("last_order_date", S, "latest purchase date"),
        ("first_order_date", S, "earliest purchase date"),
        ("order_cnt", L, "distinct orders"),
        ("total_amt", MONEY_SUM, "paid total"),
    ),
    "gmv_trend": _struct(
        ("dt", S, "yyyy-MM-dd"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "customers"),
        ("avg_order_amt", MONEY_ORDER, "average order value"),
    ),
    "product_topn": _struct(
        ("rank_num", I, "rank"),
        ("product_id", S, "product key"),
        ("product_category_name_english", S, "category label"),
        ("sales_amt", MONEY_SUM, "sales"),
        ("order_cnt", L, "orders (sum of daily counts)"),
        ("item_qty", L, "items"),
    ),
    "region_sales_rank": _struct(
        ("rank_num", I, "rank"),
        ("customer_state", S, "state label"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "sum of daily distinct customers"),
    ),
    "order_status_day": _struct(
        ("dt", S, "purchase date"),
        ("order_status", S, "status label"),
        ("order_cnt", L, "distinct orders"),
    ),
    "gmv_month": _struct(
        ("month_dt", S, "yyyy-MM"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "sum of daily distinct customers"),
        ("avg_order_amt", MONEY_ORDER, "average order value"),
    ),
    "region_sales_month": _struct(
        ("month_dt", S, "yyyy-MM"),
        ("customer_state", S, "state label"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "sum of daily distinct customers"),
    ),
    "payment_type_month": _struct(
        ("month_dt", S, "yyyy-MM"),
        ("payment_type", S, "payment type label"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
    ),
    "payment_dist": _struct(
        ("payment_type", S, "payment type label"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("gmv_pct", PCT, "share of total GMV in percent"),
    ),
    "category_topn": _struct(
        ("rank_num", I, "rank"),
        ("product_category_name_english", S, "category label"),
        ("sales_amt", MONEY_SUM, "sales"),
        ("order_cnt", L, "orders (sum of product-day counts)"),
        ("item_qty", L, "items"),
    ),
    "city_sales": _struct(
        ("rank_num", I, "rank"),
        ("customer_city", S, "city label"),
        ("customer_state", S, "state label"),
        ("gmv", MONEY_SUM, "GMV"),
        ("order_cnt", L, "orders"),
        ("customer_cnt", L, "sum of daily distinct customers"),
    ),
}

SUMMARY_TABLES = (
    "gmv_day",
    "product_sales",
    "region_day",
    "city_day",
    "payment_type_day",
    "user_order_summary",
)
MART_TABLES = (
    "gmv_trend",
    "product_topn",
    "region_sales_rank",
    "order_status_day",
    "gmv_month",
    "region_sales_month",
    "payment_type_month",
    "payment_dist",
    "category_topn",
    "city_sales",
)

# Presentation order of each mart (used by the CSV exporter; storage does not
# promise any order).
SORT_KEYS: dict[str, list[tuple[str, bool]]] = {
    "gmv_trend": [("dt", True)],
    "product_topn": [("rank_num", True)],
    "region_sales_rank": [("rank_num", True)],
    "order_status_day": [("dt", True), ("order_status", True)],
    "gmv_month": [("month_dt", True)],
    "region_sales_month": [("month_dt", True), ("gmv", False)],
    "payment_type_month": [("month_dt", True), ("gmv", False)],
    "payment_dist": [("gmv", False)],
    "category_topn": [("rank_num", True)],
    "city_sales": [("rank_num", True)],
}


def schema_of(name: str) -> T.StructType:
    if name in RAW_SCHEMAS:
        return RAW_SCHEMAS[name]
    return DERIVED_SCHEMAS[name]


def conform(df: DataFrame, schema: T.StructType | str, *, comments: bool = False) -> DataFrame:
    """Schema-on-write: select the contract columns in order and cast each to
    its declared type; with ``comments`` also attach the column comments
    (done once, when a table is written).

    Casts run under the session's ANSI setting, so a money value that does
    not fit its declared decimal fails the job instead of turning NULL.
    """
    if isinstance(schema, str):
        schema = schema_of(schema)
    # A cast to the column's own type is dropped by the optimizer, so casting
    # every column needs no look at the (analysed) input schema. Written as
    # one SQL projection it is parsed on the JVM side in a single call.
    if comments:
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType)
                           .alias(f.name, metadata=f.metadata) for f in schema.fields])
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])
