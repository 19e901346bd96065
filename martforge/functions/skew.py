"""Hot keys in joins: one salted join instead of one overfull partition.

:func:`salted_join` spreads the rows of given hot keys over ``salts`` values
and repeats only the other side's rows of those keys, so each side is scanned
and joined once. Without hot keys it is the plain join, whose skewed partitions
adaptive execution may split.

:func:`frequent_keys` finds the hot keys of several columns in one scan: every
task keeps a frequent-items summary per column (the Misra-Gries family: a
bounded table of counters, merged by adding counters) and only the summaries
travel. A key with the asked share of the rows is always in a summary, because
its error is at most half of that share; the few keys that a summary names are
then counted exactly. It runs a job, so only the pipeline calls it; building a
lazy query never does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a hot key are spread over this many join keys.
SALTS = 32
#: Largest number of counters in a summary; it bounds the smallest share.
MAX_COUNTERS = 65_536


def _share(df: DataFrame, min_share: float | None) -> float:
    if min_share is None:  # a quarter of an average shuffle partition
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        min_share = 1.0 / (4 * max(parts, 1))
    # a summary's error is at most 2.7 / counters of the rows
    return max(min_share, 8 / MAX_COUNTERS)


def frequent_keys(df: DataFrame, keys: Sequence[str], min_share: float | None = None,
                  min_rows: int = 100_000) -> dict[str, list]:
    """Per column, the non-null values that hold at least ``min_share`` of the
    rows (default: a quarter of an average shuffle partition) and ``min_rows``
    rows. At most ``1 / min_share`` values can qualify, so the lists are bounded."""
    share = _share(df, min_share)
    counters, most = math.ceil(8 / share), math.ceil(2 / share)
    summary = df.select(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"approx_top_k(`{k}`, {most}, {max(counters, most)})").alias(f"top_{i}")
        for i, k in enumerate(keys)]).first()
    least = max(min_rows, int(summary["n"] * share))
    found = {}
    for i, key in enumerate(keys):
        likely = [x["item"] for x in summary[f"top_{i}"] or [] if x["item"] is not None and x["count"] >= least]
        found[key] = _exactly(df, key, likely, least) if likely else []
    return found


def _exactly(df: DataFrame, key: str, likely: Sequence, least: int) -> list:
    mine = df.select(key)
    counts = mine.join(_key_table(mine, key, likely), key, "left_semi").groupBy(key).count()
    return sorted(r[key] for r in counts.filter(F.col("count") >= least).collect())


def hot_keys(df: DataFrame, key: str, min_share: float | None = None,
             min_rows: int = 100_000) -> list:
    """:func:`frequent_keys` of one column."""
    return frequent_keys(df, [key], min_share, min_rows)[key]


def _key_table(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """``values`` as a table; its rows are bounded by the share of a hot key."""
    kind = df.schema[key].dataType.simpleString()
    return F.broadcast(df.sparkSession.createDataFrame([(v,) for v in values], f"`{key}` {kind}"))


def salted_join(big: DataFrame, other: DataFrame, key: str, how: str,
                hot: Sequence = (), salts: int = SALTS) -> DataFrame:
    """``big.join(other, key, how)`` with the rows of ``hot`` keys spread.
    ``how`` must keep ``big``'s rows on the left (inner, left, left_semi,
    left_anti)."""
    if not hot:
        return big.join(other, key, how)
    mark, salt = "__hot", "__salt"
    marks = F.broadcast(_key_table(big, key, hot).withColumn(mark, F.lit(True)))
    is_hot = F.coalesce(mark, F.lit(False))
    names = [c for c in big.columns if c != key]
    spread = F.pmod(F.xxhash64(*names), F.lit(salts)) if names else F.lit(0)
    left = (big.join(marks, key, "left")
            .withColumn(salt, F.when(is_hot, spread).otherwise(F.lit(0)).cast("long")).drop(mark))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = (other.join(marks, key, "left")
             .withColumn(salt, F.explode(copies.cast("array<bigint>"))).drop(mark))
    return left.join(right, [key, salt], how).drop(salt)

