"""Column-level building blocks (all built-in Spark expressions)."""

from .labels import (ABNORMAL_STATUSES, DELIVERED, UNKNOWN, blank, day_of,
                     flag_count, label, month_of, present)
from .money import percent, ratio, zero_if_null
from .ranking import order_spec, rank_all, top_k_per_group, top_n
from .skew import hot_keys, salted_join

__all__ = [
    "ABNORMAL_STATUSES", "DELIVERED", "UNKNOWN", "blank",
    "day_of", "flag_count", "hot_keys", "label", "month_of", "order_spec", "percent",
    "present", "rank_all", "ratio", "salted_join", "top_k_per_group",
    "top_n", "zero_if_null",
]
