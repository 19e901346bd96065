"""Adapter from the star-schema test tables to the nine raw tables.

The test data is a TPC-H-like star schema (``orders``, ``lineitem``,
``customer``, ``nation``, ``part``, ``supplier``). This module re-shapes it,
as a Spark job over the whole tables, into the nine raw tables the warehouse
lands. The source has no NULLs, orphans or unpaid orders, so a few
deterministic key rules plant those cases; they are data defects to exercise
the semantics: rows get another key or value, and every source row is kept.

The correctness oracle rebuilds the same raw tables in SQL.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_SCHEMAS, conform

# The defect-planting key rules of the test adapter.
DROP_ORDER_MOD = 499        # order under another key -> its items become orphans
NULL_CUSTOMER_MOD = 211     # order customer_id NULL
EMPTY_TIMESTAMP_MOD = 307   # purchase timestamp ''
NULL_PRICE_MOD = 101        # item price NULL
NEGATIVE_FREIGHT_MOD = 997  # item freight negated
UNPAID_MOD = 13             # payment rows under another key -> order unpaid
SECOND_PAYMENT_MOD = 5      # order has a second 10.00 voucher payment
DROP_CUSTOMER_MOD = 41      # customer under another key -> order without customer row
NULL_STATE_MOD = 50         # customer state NULL
EMPTY_CATEGORY_MOD = 20     # product category ''

# Status and payment-type mappings.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped"}
PENDING_EVEN, PENDING_ODD = "canceled", "unavailable"
PAYMENT_TYPE_BY_PRIORITY = {
    "1": "credit_card",
    "2": "boleto",
    "3": "voucher",
    "4": "debit_card",
    "5": "credit_card",
}
SECOND_PAYMENT_TYPE = "voucher"
SECOND_PAYMENT_VALUE = "10.00"
UNTRANSLATED_TYPE = "PROMO"
ENGLISH_PREFIX = "en_"

# Declared input schemas of the star-schema tables (read without inference).
STAR_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}
STAR_TABLES = tuple(STAR_SCHEMAS)
# Free texts for the review table.
DOCUMENTS_SCHEMA = "doc_id BIGINT, text STRING, lang STRING"


def _key(prefix: str, c: str) -> str:
    return f"concat('{prefix}', CAST({c} AS STRING))"


def _stray(key: str, rule: str) -> str:
    """``key``, or for rows that ``rule`` selects a key nothing refers to."""
    return f"CASE WHEN {rule} THEN concat('x', {key}) ELSE {key} END"


def _ts_text(c: str) -> str:
    """``yyyy-MM-dd HH:mm:ss`` text of a TIMESTAMP_NTZ column. A plain cast
    involves no session time zone (a zone-aware format could shift a local
    time that falls into a daylight-saving gap)."""
    return f"CAST({c} AS STRING)"


# The projections below are SQL expressions: each table's projection is
# parsed on the JVM side in one call instead of one bridge call per column
# operation.

def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(STAR_SCHEMAS[t]).parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
            for t in STAR_TABLES}


def raw_orders(orders: DataFrame) -> DataFrame:
    out = orders.selectExpr(
        _stray(_key('o', 'o_orderkey'), f"o_orderkey % {DROP_ORDER_MOD} = 0") + " AS order_id",
        f"CASE WHEN o_orderkey % {NULL_CUSTOMER_MOD} = 0 THEN CAST(NULL AS STRING) "
        f"ELSE {_key('c', 'o_custkey')} END AS customer_id",
        f"CASE o_orderstatus WHEN 'F' THEN '{STATUS_BY_CODE['F']}' "
        f"WHEN 'O' THEN '{STATUS_BY_CODE['O']}' "
        f"WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN '{PENDING_EVEN}' "
        f"ELSE '{PENDING_ODD}' END END AS order_status",
        f"CASE WHEN o_orderkey % {EMPTY_TIMESTAMP_MOD} = 0 THEN '' "
        f"ELSE {_ts_text('o_orderdate')} END AS order_purchase_timestamp",
        "CAST(NULL AS STRING) AS order_approved_at",
        "CAST(NULL AS STRING) AS order_delivered_carrier_date",
        "CAST(NULL AS STRING) AS order_delivered_customer_date",
        "CAST(NULL AS STRING) AS order_estimated_delivery_date",
    )
    return conform(out, RAW_SCHEMAS["orders"])


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    qty = "CAST(l_quantity AS DECIMAL(10,2))"
    out = lineitem.selectExpr(
        f"{_key('o', 'l_orderkey')} AS order_id",
        "l_linenumber AS order_item_id",
        f"{_key('p', 'l_partkey')} AS product_id",
        f"{_key('s', 'l_suppkey')} AS seller_id",
        f"{_ts_text('l_shipdate')} AS shipping_limit_date",
        f"CASE WHEN l_orderkey % {NULL_PRICE_MOD} = 0 THEN CAST(NULL AS DECIMAL(10,2)) "
        f"ELSE CAST(l_extendedprice AS DECIMAL(10,2)) END AS price",
        f"CASE WHEN l_orderkey % {NEGATIVE_FREIGHT_MOD} = 0 THEN -{qty} ELSE {qty} END "
        f"AS freight_value",
    )
    return conform(out, RAW_SCHEMAS["order_items"])


def raw_order_payments(orders: DataFrame) -> DataFrame:
    order_id = _stray(_key("o", "o_orderkey"), f"o_orderkey % {UNPAID_MOD} = 0") + " AS order_id"
    whens = " ".join(f"WHEN '{code}' THEN '{name}'"
                     for code, name in PAYMENT_TYPE_BY_PRIORITY.items())
    first = orders.selectExpr(
        order_id,
        "1 AS payment_sequential",
        f"CASE substring(o_orderpriority, 1, 1) {whens} END AS payment_type",
        "1 AS payment_installments",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value",
    )
    second = orders.filter(f"o_orderkey % {SECOND_PAYMENT_MOD} = 0").selectExpr(
        order_id,
        "2 AS payment_sequential",
        f"'{SECOND_PAYMENT_TYPE}' AS payment_type",
        "1 AS payment_installments",
        f"CAST('{SECOND_PAYMENT_VALUE}' AS DECIMAL(12,2)) AS payment_value",
    )
    return conform(first.unionByName(second), RAW_SCHEMAS["order_payments"])


def _nations(nation: DataFrame) -> DataFrame:
    return nation.select("n_nationkey", "n_name")


def raw_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    out = (customer
           .join(_nations(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
           .selectExpr(
               _stray(_key('c', 'c_custkey'), f"c_custkey % {DROP_CUSTOMER_MOD} = 0")
               + " AS customer_id",
               "c_name AS customer_unique_id",
               "c_nationkey AS customer_zip_code_prefix",
               "concat(c_mktsegment, '-', n_name) AS customer_city",
               f"CASE WHEN c_custkey % {NULL_STATE_MOD} = 0 THEN CAST(NULL AS STRING) "
               f"ELSE n_name END AS customer_state",
           ))
    return conform(out, RAW_SCHEMAS["customers"])


def raw_products(part: DataFrame) -> DataFrame:
    out = part.selectExpr(
        f"{_key('p', 'p_partkey')} AS product_id",
        f"CASE WHEN p_partkey % {EMPTY_CATEGORY_MOD} = 0 THEN '' ELSE lower(p_type) END "
        f"AS product_category_name",
        "CAST(NULL AS DOUBLE) AS product_name_lenght",
        "CAST(NULL AS DOUBLE) AS product_description_lenght",
        "CAST(NULL AS DOUBLE) AS product_photos_qty",
        "CAST(p_size AS DOUBLE) AS product_weight_g",
        "CAST(NULL AS DOUBLE) AS product_length_cm",
        "CAST(NULL AS DOUBLE) AS product_height_cm",
        "CAST(NULL AS DOUBLE) AS product_width_cm",
    )
    return conform(out, RAW_SCHEMAS["products"])


def raw_category_translation(part: DataFrame) -> DataFrame:
    name = _stray("lower(p_type)", f"p_type = '{UNTRANSLATED_TYPE}'")
    out = (part.selectExpr(f"{name} AS product_category_name").distinct()
           .selectExpr("product_category_name",
                       f"concat('{ENGLISH_PREFIX}', product_category_name) "
                       f"AS product_category_name_english"))
    return conform(out, RAW_SCHEMAS["category_translation"])


def raw_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    out = (supplier.join(_nations(nation), F.col("s_nationkey") == F.col("n_nationkey"), "inner")
           .selectExpr(
               f"{_key('s', 's_suppkey')} AS seller_id",
               "s_nationkey AS seller_zip_code_prefix",
               "n_name AS seller_city",
               "n_name AS seller_state",
           ))
    return conform(out, RAW_SCHEMAS["sellers"])


def raw_geolocation(customer: DataFrame, nation: DataFrame) -> DataFrame:
    out = (customer
           .join(_nations(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
           .selectExpr(
               "c_nationkey AS geolocation_zip_code_prefix",
               "CAST(c_custkey % 180 - 90 AS DOUBLE) AS geolocation_lat",
               "CAST(c_custkey % 360 - 180 AS DOUBLE) AS geolocation_lng",
               "concat(c_mktsegment, '-', n_name) AS geolocation_city",
               "n_name AS geolocation_state",
           ))
    return conform(out, RAW_SCHEMAS["geolocation"])


def raw_order_reviews(documents: DataFrame) -> DataFrame:
    """Reviews whose messages are the documents' whole texts, line breaks and
    quotes included."""
    out = documents.selectExpr(
        f"{_key('r', 'doc_id')} AS review_id",
        f"{_key('o', 'doc_id')} AS order_id",
        "CAST(doc_id % 5 + 1 AS INT) AS review_score",
        "lang AS review_comment_title",
        "text AS review_comment_message",
        "CAST(NULL AS STRING) AS review_creation_date",
        "CAST(NULL AS STRING) AS review_answer_timestamp",
    )
    return conform(out, RAW_SCHEMAS["order_reviews"])


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    try:
        documents = spark.read.schema(DOCUMENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise  # unreadable is not the same as absent
        return spark.createDataFrame([], RAW_SCHEMAS["order_reviews"])
    return raw_order_reviews(documents)


def star_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine raw tables built from the star-schema directory ``sf_dir``.
    Nothing downstream reads sellers, reviews or geolocation; reviews come from
    the directory's ``documents`` table and are empty without one."""
    s = read_star(spark, sf_dir)
    return {
        "orders": raw_orders(s["orders"]),
        "order_items": raw_order_items(s["lineitem"]),
        "order_payments": raw_order_payments(s["orders"]),
        "customers": raw_customers(s["customer"], s["nation"]),
        "products": raw_products(s["part"]),
        "sellers": raw_sellers(s["supplier"], s["nation"]),
        "order_reviews": _reviews(spark, sf_dir),
        "geolocation": raw_geolocation(s["customer"], s["nation"]),
        "category_translation": raw_category_translation(s["part"]),
    }
