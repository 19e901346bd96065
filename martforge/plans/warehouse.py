"""The layered build as one object: raw -> detail -> summaries -> marts.

Each table is a lazily built DataFrame, computed at most once per
``Warehouse``. A ``materialize(df, name)`` hook decides what happens at
layer boundaries: by default nothing (one lazy plan, good for a single
query), in :func:`martforge.plans.pipeline.run_pipeline` a write to the
warehouse followed by a read-back, which cuts the lineage so that a lost
executor only costs the current layer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import charts as C
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import summaries as S
from ..operators.detail import payment_rollup, trade_detail_from
from ..schemas import MART_TABLES
from ..sources.landing import row_counts
from ..sources.star import star_raw

Materialize = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame], etl_date=None,
                 materialize: Materialize | None = None, hot: dict | None = None):
        self.raw = raw
        self.hot = hot or {}
        self.etl_date = etl_date
        self._mat = materialize or _lazy

    @classmethod
    def from_star(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(star_raw(spark, sf_dir), **kw)

    # detail ----------------------------------------------------------------
    @cached_property
    def payment_rollup(self) -> DataFrame:
        return payment_rollup(self.raw["order_payments"])

    @cached_property
    def detail(self) -> DataFrame:
        return self._mat(trade_detail_from(self.raw, self.etl_date, self.hot), "trade_detail")

    @cached_property
    def grain(self) -> DataFrame:
        """Shared order-level table feeding five summaries."""
        return self._mat(S.order_grain(self.detail), "_order_grain")

    @cached_property
    def regroup(self) -> bool:
        """Whether the summaries must group the grain again. Checked once on a
        written grain; a lazy build regroups, as a check would run a job."""
        return self._mat is _lazy or not S.one_row_per_order(self.grain)

    # summaries -------------------------------------------------------------
    @cached_property
    def gmv_day(self) -> DataFrame:
        return self._mat(S.gmv_day(grain=self.grain, regroup=self.regroup), "gmv_day")

    @cached_property
    def product_sales(self) -> DataFrame:
        return self._mat(S.product_sales(self.detail), "product_sales")

    @cached_property
    def region_day(self) -> DataFrame:
        return self._mat(S.region_day(grain=self.grain, regroup=self.regroup), "region_day")

    @cached_property
    def city_day(self) -> DataFrame:
        return self._mat(S.city_day(grain=self.grain, regroup=self.regroup), "city_day")

    @cached_property
    def payment_type_day(self) -> DataFrame:
        return self._mat(S.payment_type_day(grain=self.grain, regroup=self.regroup), "payment_type_day")

    @cached_property
    def user_order_summary(self) -> DataFrame:
        return self._mat(S.user_order_summary(grain=self.grain, regroup=self.regroup), "user_order_summary")

    # marts -----------------------------------------------------------------
    @cached_property
    def gmv_trend(self) -> DataFrame:
        return self._mat(M.gmv_trend(self.gmv_day), "gmv_trend")

    @cached_property
    def product_topn(self) -> DataFrame:
        return self._mat(M.product_topn(self.product_sales), "product_topn")

    @cached_property
    def region_sales_rank(self) -> DataFrame:
        return self._mat(M.region_sales_rank(self.region_day), "region_sales_rank")

    @cached_property
    def order_status_day(self) -> DataFrame:
        return self._mat(M.order_status_day(self.detail), "order_status_day")

    @cached_property
    def gmv_month(self) -> DataFrame:
        return self._mat(M.gmv_month(self.gmv_day), "gmv_month")

    @cached_property
    def region_sales_month(self) -> DataFrame:
        return self._mat(M.region_sales_month(self.region_day), "region_sales_month")

    @cached_property
    def payment_type_month(self) -> DataFrame:
        return self._mat(M.payment_type_month(self.payment_type_day), "payment_type_month")

    @cached_property
    def payment_dist(self) -> DataFrame:
        return self._mat(M.payment_dist(self.payment_type_day, self.gmv_day), "payment_dist")

    @cached_property
    def category_topn(self) -> DataFrame:
        return self._mat(M.category_topn(self.product_sales), "category_topn")

    @cached_property
    def city_sales(self) -> DataFrame:
        return self._mat(M.city_sales(self.city_day), "city_sales")

    def marts(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in MART_TABLES}

    # quality ---------------------------------------------------------------
    def quality_report(self) -> DataFrame:
        return Q.quality_report(self.raw["order_items"], self.raw["orders"], self.detail,
                                lazy=self._mat is _lazy)

    def raw_row_counts(self) -> DataFrame:
        return row_counts(self.raw)

    # charts ----------------------------------------------------------------
    def charts(self, states: list[str] | None = None,
               start_month: str | None = None) -> dict[str, DataFrame]:
        return {
            "gmv_daily_peak": C.gmv_daily_peak(self.gmv_trend),
            "gmv_mom": C.gmv_month_over_month(self.gmv_month, start_month),
            "region_top15": C.top_ranked(self.region_sales_rank),
            "category_top15": C.top_ranked(self.category_topn),
            "city_top15": C.top_ranked(self.city_sales),
            "payment_share": C.payment_share(self.payment_dist),
            "category_top3": C.category_top_products(self.product_topn),
            "abnormal_month": C.abnormal_orders_month(self.order_status_day),
            "region_month_matrix": C.region_month_matrix(self.region_sales_month, states),
            "payment_month_share": C.payment_month_share(self.payment_type_month),
        }
