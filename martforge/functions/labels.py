"""Text-date prefixes, guards and group labels.

Dates stay text end to end: a day is the first 10 characters of the purchase
timestamp and a month the first 7 characters of the day, so no parsing and
no session time zone are involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import as_col

# Fixed values shared with the reference semantics.
DELIVERED = "delivered"
UNKNOWN = "unknown"
ABNORMAL_STATUSES = ("canceled", "unavailable")


def day_of(ts: Column | str) -> Column:
    """``substr(ts, 1, 10)`` - the yyyy-MM-dd prefix."""
    return F.substring(as_col(ts), 1, 10)


def month_of(dt: Column | str) -> Column:
    """``substr(dt, 1, 7)`` - the yyyy-MM prefix."""
    return F.substring(as_col(dt), 1, 7)


def present(c: Column | str) -> Column:
    """``c IS NOT NULL AND c != ''``."""
    c = as_col(c)
    return c.isNotNull() & (c != "")


def blank(c: Column | str) -> Column:
    """``c IS NULL OR c = ''``."""
    c = as_col(c)
    return c.isNull() | (c == "")


def label(c: Column | str, name: str | None = None) -> Column:
    """``COALESCE(c, 'unknown')``. Apply it *after* grouping on the raw
    column so a NULL and a literal 'unknown' stay two groups."""
    out = F.coalesce(as_col(c), F.lit(UNKNOWN))
    if name is None and isinstance(c, str):
        name = c
    return out.alias(name) if name else out


def flag_count(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` - NULL on empty input, like
    the SQL it replaces (``count_if`` would give 0)."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("long")
