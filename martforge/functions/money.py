"""Decimal arithmetic used by the summaries and marts.

All of it stays in built-in column expressions (codegen, no Python per row).
Division goes through ``try_divide`` so a zero denominator yields NULL, the
way the reference dialect behaves, instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, scale: int = 2,
          dtype: T.DecimalType | None = None) -> Column:
    """``ROUND(num / den, scale)`` with HALF_UP rounding; NULL when ``den`` is
    0 or NULL. Optionally cast to the contract decimal."""
    out = F.round(F.try_divide(as_col(num), as_col(den)), scale)
    return out.cast(dtype) if dtype is not None else out


def percent(part: Column | str, total: Column | str, scale: int = 2,
            dtype: T.DecimalType | None = T.DecimalType(5, 2)) -> Column:
    """``ROUND(part * 100.0 / total, scale)``; NULL on a zero total."""
    out = F.round(F.try_divide(as_col(part) * F.lit(100.0).cast("decimal(4,1)"),
                               as_col(total)), scale)
    return out.cast(dtype) if dtype is not None else out


def zero_if_null(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """``COALESCE(c, 0)`` keeping the column's decimal type."""
    c = as_col(c)
    zero = F.lit(0)
    if dtype is not None:
        zero = zero.cast(dtype)
    return F.coalesce(c, zero)
