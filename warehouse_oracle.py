"""DuckDB SQL for every query of the warehouse, for the correctness check.

Formulated apart from the Spark jobs: all money is integer cents; one table
``fact`` holds the item lines and one table ``bought`` the distinct purchases
(order, day, customer, place, payment), from which :func:`purchases` derives
every order-level summary by making it distinct on that summary's own keys;
ranked reports come from :func:`ranked`.
"""

from __future__ import annotations

from martforge.sources import star as A

ETL_DATE = "2026-01-01"
START_MONTH = "1994-01"
MATRIX_STATES = [f"NATION_{i}" for i in range(25)] + ["unknown"]


def money(cents: str, digits: int = 14) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(36,0)) * 0.01 AS DECIMAL({digits},2))"


def ratio(over: str, under: str, digits: int) -> str:
    """``over / under`` (integers) in hundredths, half away from zero."""
    sign = f"sign({over}) * sign({under})"
    size = f"(200 * abs({over}) + abs({under})) // (2 * nullif(abs({under}), 0))"
    return money(f"{sign} * ({size})", digits)


def keyed(prefix: str, column: str, stray: str | None = None) -> str:
    """Text key; rows that ``stray`` selects get a key that nothing refers to."""
    key = f"concat('{prefix}', {column})"
    return key if stray is None else f"if({stray}, concat('x', {key}), {key})"


PAY_TYPE = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in A.PAYMENT_TYPE_BY_PRIORITY.items()) + "}"
UNPAID = f"o_orderkey % {A.UNPAID_MOD} = 0"

TABLES: dict[str, str] = {
    "head": f"""
        SELECT {keyed('o', 'o_orderkey', f'o_orderkey % {A.DROP_ORDER_MOD} = 0')} AS order_id,
               if(o_orderkey % {A.NULL_CUSTOMER_MOD} = 0, NULL, {keyed('c', 'o_custkey')})
                 AS customer_id,
               map {{'F': 'delivered', 'O': 'shipped',
                     'P': if(o_orderkey % 2 = 0, 'canceled', 'unavailable')}}[o_orderstatus]
                 AS order_status,
               if(o_orderkey % {A.EMPTY_TIMESTAMP_MOD} = 0, '',
                  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS bought_at
        FROM orders""",
    "line": f"""
        SELECT {keyed('o', 'l_orderkey')} AS order_id, CAST(l_linenumber AS INTEGER) AS nr,
               {keyed('p', 'l_partkey')} AS product_id, {keyed('s', 'l_suppkey')} AS seller_id,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship_by,
               if(l_orderkey % {A.NULL_PRICE_MOD} = 0, NULL,
                  CAST(round(l_extendedprice * 100) AS BIGINT)) AS price_c,
               CAST(round(l_quantity * 100) AS BIGINT)
                 * if(l_orderkey % {A.NEGATIVE_FREIGHT_MOD} = 0, -1, 1) AS freight_c
        FROM lineitem""",
    "payment": f"""
        SELECT {keyed('o', 'o_orderkey', UNPAID)} AS order_id, seq,
               if(seq = 1, {PAY_TYPE}[left(o_orderpriority, 1)], '{A.SECOND_PAYMENT_TYPE}') AS kind,
               if(seq = 1, CAST(round(o_totalprice * 100) AS BIGINT),
                  CAST({A.SECOND_PAYMENT_VALUE} * 100 AS BIGINT)) AS cents
        FROM orders, (VALUES (1), (2)) AS s(seq)
        WHERE seq = 1 OR o_orderkey % {A.SECOND_PAYMENT_MOD} = 0""",
    "buyer": f"""
        SELECT {keyed('c', 'c_custkey', f'c_custkey % {A.DROP_CUSTOMER_MOD} = 0')} AS customer_id,
               c_name AS name, CAST(c_nationkey AS INTEGER) AS zip,
               concat(c_mktsegment, '-', n_name) AS city,
               if(c_custkey % {A.NULL_STATE_MOD} = 0, NULL, n_name) AS state
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "good": f"""
        SELECT {keyed('p', 'p_partkey')} AS product_id,
               if(p_partkey % {A.EMPTY_CATEGORY_MOD} = 0, '', lower(p_type)) AS category,
               CAST(p_size AS DOUBLE) AS grams
        FROM part""",
    "english": f"""
        SELECT DISTINCT if(p_type = '{A.UNTRANSLATED_TYPE}', concat('x', lower(p_type)),
                           lower(p_type)) AS category,
               concat('{A.ENGLISH_PREFIX}', category) AS english
        FROM part""",
    # lowest sequence first, then the smaller kind: one sortable text
    "paid": """
        SELECT order_id, substr(min(printf('%08d', seq) || kind), 9) AS kind,
               CAST(sum(cents) AS BIGINT) AS cents
        FROM payment GROUP BY order_id""",
    "fact": """
        SELECT line.*, coalesce(price_c, 0) AS p, coalesce(freight_c, 0) AS f,
               head.customer_id, order_status, bought_at, left(bought_at, 10) AS day,
               paid.kind, paid.cents, city, state, good.category, english, grams
        FROM head
        JOIN line USING (order_id)
        LEFT JOIN paid USING (order_id)
        LEFT JOIN buyer ON buyer.customer_id = head.customer_id
        LEFT JOIN good USING (product_id)
        LEFT JOIN english ON english.category = good.category
        WHERE head.customer_id IS NOT NULL""",
    "bought": """
        SELECT DISTINCT order_id, day, customer_id, city, state, kind, cents FROM fact
        WHERE order_status = 'delivered' AND day IS NOT NULL""",
    "profile": """
        SELECT count(*) AS total_cnt,
               count(*) FILTER (nullif(order_id, '') IS NULL) AS order_id_null_cnt,
               count(*) FILTER (nullif(customer_id, '') IS NULL) AS customer_id_null_cnt,
               count(*) FILTER (nullif(product_id, '') IS NULL) AS product_id_null_cnt,
               count(*) FILTER (p < 0) AS price_negative_cnt,
               count(*) FILTER (f < 0) AS freight_negative_cnt,
               count(*) FILTER (coalesce(kind, CAST(cents AS VARCHAR)) IS NULL) AS no_payment_cnt
        FROM fact""",
    "repeated": "SELECT order_id, nr FROM fact GROUP BY ALL HAVING count(*) > 1",
    "stray_line": "SELECT * FROM line ANTI JOIN head USING (order_id)",
}


def purchases(keys: dict[str, str], buyers: bool = True, average: bool = False) -> str:
    """Daily order-level summary: ``keys`` maps output names to columns of
    ``bought``; a NULL label reads 'unknown' but stays its own group."""
    columns = list(dict.fromkeys(["day", "order_id", *(["customer_id"] if buyers else []),
                                  *keys.values(), "cents"]))
    shown = [f"coalesce({c}, 'unknown') AS {name}" for name, c in keys.items()]
    shown += ["day AS dt", f"{money('sum(cents)')} AS gmv", "count(*) AS order_cnt"]
    if buyers:
        shown.append("count(DISTINCT customer_id) AS customer_cnt")
    if average:
        shown.append(f"{ratio('CAST(sum(cents) AS HUGEINT)', 'count(*) * 100', 12)} AS avg_order_amt")
    return (f"SELECT {', '.join(shown)} FROM (SELECT DISTINCT {', '.join(columns)} FROM bought "
            f"WHERE day <> '') GROUP BY {', '.join(['day', *keys.values()])}")


def added(source: str, keys: list[str], sums: list[str], month: bool = False,
          average: bool = False) -> str:
    """Roll-up of a summary: money and counts added up by ``keys``."""
    group = (["left(dt, 7) AS month_dt"] if month else []) + keys
    money_columns = {"gmv", "sales_amt"}
    shown = group + [f"CAST(sum({s}) AS {'DECIMAL(14,2)' if s in money_columns else 'BIGINT'}) AS {s}"
                     for s in sums]
    if average:
        shown.append(ratio("CAST(sum(gmv) * 100 AS HUGEINT)",
                           "CAST(sum(order_cnt) * 100 AS HUGEINT)", 12) + " AS avg_order_amt")
    return f"SELECT {', '.join(shown)} FROM {source} GROUP BY {', '.join(g.split(' AS ')[0] for g in group)}"


def ranked(source: str, metric: str, keys: list[str], columns: list[str], top: int | None = None,
           within: str = "", name: str = "rank_num") -> str:
    order = ", ".join([f"{metric} DESC NULLS LAST", *(f"{k} NULLS FIRST" for k in keys)])
    part = f"PARTITION BY {within} " if within else ""
    cut = f" QUALIFY {name} <= {top}" if top else ""
    return (f"SELECT CAST(row_number() OVER ({part}ORDER BY {order}) AS INTEGER) AS {name}, "
            f"{', '.join(columns)} FROM ({source}){cut}")


def share(column: str, whole: str) -> str:
    return ratio(f"CAST({column} * 10000 AS HUGEINT)", f"CAST({whole} * 100 AS HUGEINT)", 5)


SALES = ["sales_amt", "order_cnt", "item_qty"]
GMV = ["gmv", "order_cnt", "customer_cnt"]
PRODUCT = ["product_id", "product_category_name_english"]

TABLES |= {
    "gmv_day": purchases({}, average=True),
    "region_day": purchases({"customer_state": "state"}),
    "city_day": purchases({"customer_city": "city", "customer_state": "state"}),
    "payment_type_day": purchases({"payment_type": "kind"}, buyers=False),
    "product_sales": f"""
        SELECT product_id, coalesce(english, 'unknown') AS product_category_name_english, day AS dt,
               {money('sum(p + f)')} AS sales_amt, count(DISTINCT order_id) AS order_cnt,
               count(*) AS item_qty, count(DISTINCT customer_id) AS buyer_cnt
        FROM fact WHERE order_status = 'delivered' AND day <> ''
        GROUP BY product_id, english, day""",
    "user_order_summary": f"""
        SELECT customer_id, max(day) AS last_order_date, min(day) AS first_order_date,
               count(DISTINCT order_id) AS order_cnt, {money('sum(cents)')} AS total_amt
        FROM (SELECT DISTINCT customer_id, order_id, day, cents FROM bought) GROUP BY customer_id""",
    "order_status_day": """
        SELECT day AS dt, coalesce(order_status, 'unknown') AS order_status,
               count(DISTINCT order_id) AS order_cnt
        FROM fact WHERE day <> '' GROUP BY day, fact.order_status""",
}
TABLES |= {
    "gmv_trend": f"SELECT dt, {', '.join(GMV)}, avg_order_amt FROM gmv_day",
    "gmv_month": added("gmv_day", [], GMV, month=True, average=True),
    "region_sales_month": added("region_day", ["customer_state"], GMV, month=True),
    "payment_type_month": added("payment_type_day", ["payment_type"], GMV[:2], month=True),
    "product_topn": ranked(added("product_sales", PRODUCT, SALES), "sales_amt", PRODUCT,
                           PRODUCT + SALES, 100),
    "category_topn": ranked(added("product_sales", PRODUCT[1:], SALES), "sales_amt", PRODUCT[1:],
                            PRODUCT[1:] + SALES, 50),
    "region_sales_rank": ranked(added("region_day", ["customer_state"], GMV), "gmv",
                                ["customer_state"], ["customer_state", *GMV]),
    "city_sales": ranked(added("city_day", ["customer_city", "customer_state"], GMV), "gmv",
                         ["customer_city", "customer_state"],
                         ["customer_city", "customer_state", *GMV], 100),
    "payment_dist": f"""
        SELECT *, {share('gmv', '(SELECT sum(gmv) FROM gmv_day)')} AS gmv_pct
        FROM ({added('payment_type_day', ['payment_type'], GMV[:2])})""",
}

LINE_COLUMNS = ("order_id, nr AS order_item_id, product_id, seller_id, ship_by AS shipping_limit_date, "
                f"{money('price_c', 10)} AS price, {money('freight_c', 10)} AS freight_value")


# Check, metric, expected text, and the kind of expectation.
REPORT_ROWS = (
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
)


def report() -> str:
    """The checks of the combined report, one row each."""
    extra = {"detail_rows": "total_cnt", "source_rows": "(SELECT count(*) FROM line)",
             "duplicate_count": "(SELECT count(*) FROM repeated)",
             "items_without_order": "(SELECT count(*) FROM stray_line)",
             "no_payment_pct": ratio("CAST(no_payment_cnt * 100 AS HUGEINT)", "total_cnt", 5)}
    rows = []
    for check, metric, expected, rule in REPORT_ROWS:
        value = extra.get(metric, metric)
        passed = {"zero": f"{value} = 0", "le_source": f"total_cnt <= {extra['source_rows']}"}.get(
            rule, "CAST(NULL AS BOOLEAN)")
        told = "CAST(NULL AS VARCHAR)" if expected is None else f"'{expected}'"
        rows.append(f"SELECT '{check}' AS \"check\", '{metric}' AS metric, "
                    f"CAST({value} AS DECIMAL(20,2)) AS value, {told} AS expected, "
                    f"{passed} AS passed FROM profile")
    return " UNION ALL ".join(rows)


def counts(tables: dict[str, str], label: str, number: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS {label}, CAST(({sql}) AS BIGINT) AS {number}"
                              for name, sql in tables.items())


def count_of(source: str) -> str:
    return f"SELECT count(*) FROM {source}"


RAW_COUNTS = {"orders": count_of("head"), "order_items": count_of("line"),
              "order_payments": count_of("payment"), "customers": count_of("buyer"),
              "products": count_of("good"),
              "sellers": count_of("supplier JOIN nation ON n_nationkey = s_nationkey"),
              "category_translation": count_of("english"), "order_reviews": count_of("documents"),
              "geolocation": count_of("customer JOIN nation ON n_nationkey = c_nationkey")}

# Numbers of the damaged items that do not parse, by column.
ORDER_KEY = "CAST(substr(order_id, 2) AS BIGINT)"
DAMAGE = {"order_item_id": (17, "concat('x', nr)"), "price": (23, "'n/a'"), "freight_value": (29, "'1.2.3'")}
DAMAGED = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {value} AS value FROM line WHERE {ORDER_KEY} % {mod} = 0"
                             for c, (mod, value) in DAMAGE.items())
LANDED = {"customers": (count_of("buyer"), "0"), "order_items": (count_of("line"), f"SELECT count(*) FROM ({DAMAGED})"),
          "order_reviews": (count_of("documents"), "0")}

BODIES: dict[str, str] = {
    **{name: f"SELECT * FROM {name}" for name in (
        "gmv_day", "product_sales", "region_day", "city_day", "payment_type_day",
        "user_order_summary", "gmv_trend", "product_topn", "region_sales_rank", "order_status_day",
        "gmv_month", "region_sales_month", "payment_type_month", "payment_dist", "category_topn",
        "city_sales")},
    "payment_rollup": f"SELECT order_id, kind AS payment_type, {money('cents', 12)} "
                      "AS payment_value_sum FROM paid",
    "trade_detail": f"""
        SELECT order_id, customer_id, order_status, bought_at AS order_purchase_timestamp,
               day AS order_purchase_date, nr AS order_item_id, product_id, seller_id,
               {money('p', 10)} AS price, {money('f', 10)} AS freight_value,
               {money('p + f', 10)} AS item_total_amount, kind AS payment_type,
               {money('cents', 12)} AS payment_value_sum, city AS customer_city,
               state AS customer_state, category AS product_category_name,
               english AS product_category_name_english, grams AS product_weight_g,
               '{ETL_DATE}' AS etl_date
        FROM fact""",
    "order_level": f"SELECT DISTINCT day AS order_purchase_date, order_id, customer_id, "
                   f"{money('cents', 12)} AS pay_amt FROM bought WHERE day <> ''",
    # CSV can't tell NULL from empty text: read back, both are ''
    "csv_roundtrip_orders": """
        SELECT order_id, coalesce(customer_id, '') AS customer_id, order_status,
               bought_at AS order_purchase_timestamp, '' AS order_approved_at,
               '' AS order_delivered_carrier_date, '' AS order_delivered_customer_date,
               '' AS order_estimated_delivery_date
        FROM head""",
    "csv_roundtrip_order_items": f"SELECT {LINE_COLUMNS} FROM line",
    "csv_roundtrip_order_payments": f"""
        SELECT order_id, CAST(seq AS INTEGER) AS payment_sequential, kind AS payment_type,
               CAST(1 AS INTEGER) AS payment_installments, {money('cents', 12)} AS payment_value
        FROM payment""",
    "csv_roundtrip_customers": """
        SELECT customer_id, name AS customer_unique_id, zip AS customer_zip_code_prefix,
               city AS customer_city, coalesce(state, '') AS customer_state
        FROM buyer""",
    "csv_roundtrip_category_translation": """
        SELECT category AS product_category_name, english AS product_category_name_english
        FROM english""",
    "reviews_roundtrip": """
        SELECT concat('r', doc_id) AS review_id, concat('o', doc_id) AS order_id,
               CAST(doc_id % 5 + 1 AS INTEGER) AS review_score, coalesce(lang, '') AS review_comment_title,
               coalesce(text, '') AS review_comment_message, '' AS review_creation_date,
               '' AS review_answer_timestamp
        FROM documents""",
    "single_file_order_status_day": "SELECT row_number() OVER (ORDER BY dt, order_status) AS line_no, * "
                                    "FROM order_status_day",
    "published_payment_type_month": "SELECT * FROM payment_type_month",
    "csv_rejects": f'SELECT "column", value, count(*) AS cnt FROM ({DAMAGED}) GROUP BY ALL',
    "landing_status": " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, 'ok' AS status, ({rows}) AS rows, ({bad}) AS rejected" for n, (rows, bad) in LANDED.items())
    + " UNION ALL SELECT 'sellers', 'skipped', NULL, NULL",
    "export_status": " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", 'ok' AS status, ({count_of(n)}) AS rows"
        for n in ("gmv_month", "payment_dist", "region_sales_month"))
    + " UNION ALL SELECT 'no_such_mart', 'failed', NULL",
    "raw_row_counts": counts(RAW_COUNTS, "tbl", "cnt"),
    "dq_row_counts": counts({"order_items": count_of("line"), "trade_detail": count_of("fact")},
                            "source", "row_count"),
    "dq_duplicates": "SELECT count(*) AS duplicate_count FROM repeated",
    "dq_duplicate_groups": "SELECT order_id, nr AS order_item_id, count(*) AS cnt "
                           "FROM fact SEMI JOIN repeated USING (order_id, nr) GROUP BY ALL",
    "dq_nulls": "SELECT order_id_null_cnt, customer_id_null_cnt, product_id_null_cnt, total_cnt "
                "FROM profile",
    "dq_negative_amounts": "SELECT price_negative_cnt, freight_negative_cnt FROM profile",
    "dq_orphan_items": "SELECT count(*) AS items_without_order FROM stray_line",
    "anti_join_orphans": f"SELECT {LINE_COLUMNS} FROM stray_line",
    "dq_payment_coverage": "SELECT no_payment_cnt, total_cnt, "
                           + ratio("CAST(no_payment_cnt * 100 AS HUGEINT)", "total_cnt", 5)
                           + " AS no_payment_pct FROM profile",
    "dq_status_dist": "SELECT order_status, count(*) AS cnt FROM fact GROUP BY ALL",
    "dq_report": report(),
    "chart_gmv_daily_peak": "SELECT dt, gmv, order_cnt, coalesce(gmv = max(gmv) OVER (), false) "
                            "AS is_peak FROM gmv_trend",
    "chart_gmv_mom": f"""
        SELECT month_dt, gmv, order_cnt, prev_gmv,
               {ratio('CAST((gmv - prev_gmv) * 10000 AS HUGEINT)', 'CAST(prev_gmv * 100 AS HUGEINT)', 12)}
                 AS mom_pct
        FROM (SELECT *, lag(gmv) OVER (ORDER BY month_dt) AS prev_gmv FROM gmv_month)
        WHERE month_dt >= '{START_MONTH}'""",
    **{f"chart_{name}_top15": f"SELECT * FROM {mart} WHERE rank_num <= 15" for name, mart in (
        ("region", "region_sales_rank"), ("category", "category_topn"), ("city", "city_sales"))},
    "chart_payment_share": "SELECT payment_type, gmv, gmv_pct FROM payment_dist",
    "chart_category_top3": ranked(
        "SELECT * FROM product_topn", "sales_amt", ["product_id"],
        ["product_category_name_english", "product_id", "sales_amt", "rank_num"], 3,
        "product_category_name_english", "category_rank"),
    "chart_abnormal_month": added(
        "(SELECT * FROM order_status_day WHERE order_status IN ('canceled', 'unavailable'))",
        ["order_status"], ["order_cnt"], month=True),
    "chart_region_month_matrix": "SELECT month_dt, " + ", ".join(
        f"CAST(sum(gmv) FILTER (customer_state = '{s}') AS DECIMAL(14,2)) AS \"{s}\""
        for s in MATRIX_STATES) + " FROM region_sales_month GROUP BY month_dt",
    "chart_payment_month_share": f"""
        SELECT month_dt, payment_type, gmv, {share('gmv', 'month_gmv')} AS gmv_pct
        FROM (SELECT *, sum(gmv) OVER (PARTITION BY month_dt) AS month_gmv
              FROM payment_type_month)""",
}


# Columns of two marts as their contract has them.
CONTRACT = {
    "category_topn": [("rank_num", "int", "rank"), ("product_category_name_english", "string", "category label"),
                      ("sales_amt", "decimal(14,2)", "sales"),
                      ("order_cnt", "bigint", "orders (sum of product-day counts)"), ("item_qty", "bigint", "items")],
    "payment_dist": [("payment_type", "string", "payment type label"), ("gmv", "decimal(14,2)", "GMV"),
                     ("order_cnt", "bigint", "orders"), ("gmv_pct", "decimal(5,2)", "share of total GMV in percent")],
}
BODIES["catalog_columns"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, CAST({i + 1} AS INTEGER) AS position, '{c}' AS \"column\", '{kind}' AS type, "
    f"'{comment}' AS comment, 'ok' AS status, ({count_of(t)}) AS table_rows"
    for t, columns in CONTRACT.items() for i, (c, kind, comment) in enumerate(columns))
BODIES["text_layer_trade_detail"] = BODIES["trade_detail"]


def oracle_queries() -> dict[str, str]:
    prefix = "WITH " + ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in TABLES.items())
    return {name: f"{prefix}\n{body.strip()}" for name, body in BODIES.items()}
