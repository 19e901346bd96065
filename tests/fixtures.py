"""Hand-written raw tables (fixture set A): each case pins one semantic rule."""

from __future__ import annotations

from decimal import Decimal

from martforge.schemas import RAW_SCHEMAS


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


def raw_frames(spark, orders=(), items=(), payments=(), customers=(), products=(),
               translation=()):
    """Nine raw DataFrames from short tuples.

    orders: (order_id, customer_id, status, purchase_ts)
    items: (order_id, item_id, product_id, price, freight)
    payments: (order_id, seq, type, value)
    customers: (customer_id, city, state)
    products: (product_id, category)
    translation: (category, english)
    """
    def mk(name, rows):
        return spark.createDataFrame(list(rows), RAW_SCHEMAS[name])

    return {
        "orders": mk("orders", [(o, c, s, t, None, None, None, None) for o, c, s, t in orders]),
        "order_items": mk("order_items", [(o, i, p, "s1", "2017-01-01 00:00:00", D(pr), D(fr))
                                          for o, i, p, pr, fr in items]),
        "order_payments": mk("order_payments", [(o, s, t, 1, D(v)) for o, s, t, v in payments]),
        "customers": mk("customers", [(c, c + "_u", 1, city, st) for c, city, st in customers]),
        "products": mk("products", [(p, cat, None, None, None, 100.0, None, None, None)
                                    for p, cat in products]),
        "sellers": mk("sellers", []),
        "order_reviews": mk("order_reviews", []),
        "geolocation": mk("geolocation", []),
        "category_translation": mk("category_translation", list(translation)),
    }
