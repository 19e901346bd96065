"""Fixture set A: one small hand-written case per semantic rule."""

from decimal import Decimal

from fixtures import D, raw_frames

from martforge.operators import charts as C
from martforge.operators import marts as M
from martforge.operators import quality as Q
from martforge.operators import summaries as S
from martforge.operators.detail import trade_detail_from
from martforge.plans.warehouse import Warehouse

TS = "2017-03-01 10:00:00"
CUST = [("c1", "city1", "SP")]
PROD = [("p1", "toys"), ("p2", "toys")]
TRANS = [("toys", "toys_en")]


def _wh(spark, **kw):
    kw.setdefault("customers", CUST)
    kw.setdefault("products", PROD)
    kw.setdefault("translation", TRANS)
    return Warehouse(raw_frames(spark, **kw), etl_date="2026-01-01")


def test_a1_fan_out_counts_order_once(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)],
            items=[("o1", 1, "p1", 10, 1), ("o1", 2, "p1", 10, 1), ("o1", 3, "p2", 10, 1)],
            payments=[("o1", 1, "credit_card", 70), ("o1", 2, "voucher", 30)])
    det = w.detail.collect()
    assert len(det) == 3
    assert {r.payment_type for r in det} == {"credit_card"}
    assert {r.payment_value_sum for r in det} == {D(100)}
    g = w.gmv_day.collect()
    assert [(r.dt, r.gmv, r.order_cnt, r.customer_cnt) for r in g] == \
        [("2017-03-01", D("100.00"), 1, 1)]


def test_a2_first_payment_by_sequence(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)], items=[("o1", 1, "p1", 1, 1)],
            payments=[("o1", 2, "boleto", 5), ("o1", 1, "voucher", 5)])
    assert w.payment_rollup.collect()[0].payment_type == "voucher"


def test_a3_unpaid_order_counts_but_sums_null(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)], items=[("o1", 1, "p1", 1, 1)])
    g = w.gmv_day.collect()[0]
    assert g.order_cnt == 1 and g.gmv is None and g.avg_order_amt is None
    p = w.payment_type_day.collect()
    assert [(r.payment_type, r.gmv, r.order_cnt) for r in p] == [("unknown", None, 1)]


def test_a4_status_filter_only_on_money(spark):
    w = _wh(spark, orders=[("o1", "c1", "canceled", TS)], items=[("o1", 1, "p1", 1, 1)],
            payments=[("o1", 1, "boleto", 2)])
    assert w.gmv_day.count() == 0
    s = w.order_status_day.collect()
    assert [(r.dt, r.order_status, r.order_cnt) for r in s] == [("2017-03-01", "canceled", 1)]


def test_a5_empty_date_guard_is_asymmetric(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", "")], items=[("o1", 1, "p1", 1, 1)],
            payments=[("o1", 1, "boleto", 2)])
    assert w.gmv_day.count() == 0
    u = w.user_order_summary.collect()
    assert [(r.customer_id, r.first_order_date, r.last_order_date, r.order_cnt) for r in u] \
        == [("c1", "", "", 1)]


def test_a6_null_and_literal_unknown_stay_apart_then_merge(spark):
    w = _wh(spark,
            orders=[("o1", "c1", "delivered", TS), ("o2", "c2", "delivered", TS)],
            items=[("o1", 1, "p1", 1, 1), ("o2", 1, "p1", 1, 1)],
            payments=[("o1", 1, "boleto", 2), ("o2", 1, "boleto", 3)],
            customers=[("c1", "x", None), ("c2", "y", "unknown")])
    rd = w.region_day.collect()
    assert sorted((r.customer_state, r.gmv) for r in rd) == \
        [("unknown", D("2.00")), ("unknown", D("3.00"))]
    rk = w.region_sales_rank.collect()
    assert [(r.rank_num, r.customer_state, r.gmv) for r in rk] == [(1, "unknown", D("5.00"))]


def test_a7_orphans(spark):
    w = _wh(spark,
            orders=[("o2", None, "delivered", TS), ("o3", "c1", "delivered", TS)],
            items=[("o1", 1, "p1", 1, 1), ("o2", 1, "p1", 1, 1)])
    assert w.detail.count() == 0
    oc = Q.orphan_check(w.raw["order_items"], w.raw["orders"]).collect()[0]
    assert oc.items_without_order == 1


def test_a8_null_money_reads_as_zero(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)], items=[("o1", 1, "p1", None, 4.5)])
    r = w.detail.collect()[0]
    assert (r.price, r.freight_value, r.item_total_amount) == (D("0.00"), D("4.50"), D("4.50"))


def test_a9_untranslated_and_empty_category(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)],
            items=[("o1", 1, "p1", 1, 0), ("o1", 2, "p2", 1, 0)],
            products=[("p1", "garden"), ("p2", "")])
    assert {r.product_category_name_english for r in w.detail.collect()} == {None}
    assert {r.product_category_name_english for r in w.product_sales.collect()} == {"unknown"}


def test_a10_non_additive_rollups_are_kept(spark):
    w = _wh(spark,
            orders=[("o1", "c1", "delivered", "2017-03-01 10:00:00"),
                    ("o2", "c1", "delivered", "2017-03-02 10:00:00")],
            items=[("o1", 1, "p1", 1, 0), ("o1", 2, "p2", 1, 0), ("o2", 1, "p1", 1, 0)],
            payments=[("o1", 1, "boleto", 2), ("o2", 1, "boleto", 2)])
    m = w.gmv_month.collect()[0]
    assert (m.month_dt, m.customer_cnt, m.order_cnt) == ("2017-03", 2, 2)
    cat = w.category_topn.collect()[0]
    assert cat.order_cnt == 3  # o1 once per product-day (2) + o2 (1)


def test_a11_ties_rank_by_key(spark):
    w = _wh(spark,
            orders=[(f"o{i}", f"c{i}", "delivered", TS) for i in range(3)],
            items=[(f"o{i}", 1, "p1", 1, 0) for i in range(3)],
            payments=[(f"o{i}", 1, "boleto", 5) for i in range(3)],
            customers=[("c0", "x", "RJ"), ("c1", "x", "AM"), ("c2", "x", "SP")])
    rk = w.region_sales_rank.orderBy("rank_num").collect()
    assert [(r.rank_num, r.customer_state) for r in rk] == [(1, "AM"), (2, "RJ"), (3, "SP")]


def test_a12_zero_total_share_is_null(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)], items=[("o1", 1, "p1", 1, 0)],
            payments=[("o1", 1, "boleto", 0)])
    r = w.payment_dist.collect()[0]
    assert r.gmv == D("0.00") and r.gmv_pct is None


def test_a13_empty_input(spark):
    w = _wh(spark)
    for name, df in w.marts().items():
        assert df.count() == 0, name
    n = Q.null_check(w.detail).collect()[0]
    assert n.total_cnt == 0 and n.order_id_null_cnt is None
    assert Q.duplicate_check(w.detail).collect()[0].duplicate_count == 0
    rep = w.quality_report().collect()
    assert len(rep) == len(Q.REPORT_ROWS)


def test_a15_duplicate_key(spark):
    w = _wh(spark, orders=[("o1", "c1", "delivered", TS)],
            items=[("o1", 1, "p1", 1, 0), ("o1", 1, "p1", 1, 0)])
    assert Q.duplicate_check(w.detail).collect()[0].duplicate_count == 1


def test_a16_half_cent_rounds_up(spark):
    w = _wh(spark,
            orders=[("o1", "c1", "delivered", TS), ("o2", "c1", "delivered", TS)],
            items=[("o1", 1, "p1", 1, 0), ("o2", 1, "p1", 1, 0)],
            payments=[("o1", 1, "boleto", "144087.73"), ("o2", 1, "boleto", "144087.74")])
    g = w.gmv_day.collect()[0]
    assert g.gmv == D("288175.47") and g.avg_order_amt == D("144087.74")


def test_literal_and_shared_grain_agree(spark, smoke_dir):
    w = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01")
    det = w.detail
    pairs = [
        (S.gmv_day(det), S.gmv_day(grain=w.grain)),
        (S.region_day(det), S.region_day(grain=w.grain)),
        (S.city_day(det), S.city_day(grain=w.grain)),
        (S.payment_type_day(det), S.payment_type_day(grain=w.grain)),
        (S.user_order_summary(det), S.user_order_summary(grain=w.grain)),
    ]
    for a, b in pairs:
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_invariants(spark, smoke_dir):
    from pyspark.sql import functions as F
    w = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01")
    total = w.gmv_day.agg(F.sum("gmv")).first()[0]
    for df in (w.region_day, w.city_day, w.payment_type_day, w.gmv_month):
        assert df.agg(F.sum("gmv")).first()[0] == total
    per_day = w.gmv_day.select("dt", F.col("gmv").alias("g"))
    for df in (w.region_day, w.city_day, w.payment_type_day):
        s = df.groupBy("dt").agg(F.sum("gmv").alias("s"))
        bad = per_day.join(s, "dt", "full").filter(~F.col("g").eqNullSafe(F.col("s")))
        assert bad.count() == 0
    ranks = [r.rank_num for r in w.region_sales_rank.orderBy("rank_num").collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    shares = C.payment_month_share(w.payment_type_month) \
        .groupBy("month_dt").agg(F.sum("gmv_pct").alias("p")).collect()
    assert all(r.p is None or abs(r.p - Decimal(100)) <= Decimal("0.05") for r in shares)
    assert w.detail.count() <= Q.source_items(w.raw["order_items"]).count()


def test_status_mart_reads_detail(spark, smoke_dir):
    w = Warehouse.from_star(spark, smoke_dir, etl_date="2026-01-01")
    assert M.order_status_day(w.detail).count() == 1332


def test_detail_built_from_raw_dict(spark, smoke_dir):
    w = Warehouse.from_star(spark, smoke_dir)
    assert trade_detail_from(w.raw, "2026-01-01").count() == 5940


def test_adapter_text_dates_ignore_session_time_zone(spark, smoke_dir):
    from martforge.sources.star import star_raw
    before = sorted(r[0] for r in star_raw(spark, smoke_dir)["orders"]
                    .select("order_purchase_timestamp").collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        after = sorted(r[0] for r in star_raw(spark, smoke_dir)["orders"]
                       .select("order_purchase_timestamp").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after and before[-1].endswith(" 00:00:00")
