"""ROW_NUMBER rankings without pulling a whole table into one task.

* :func:`top_n` - global ``ROW_NUMBER() OVER (ORDER BY ...)`` kept to
  ``rank <= n``. Written as sort + limit first, so Spark plans a
  TakeOrderedAndProject (each task keeps its own n best rows); only the final
  ``n`` rows meet in one task to be numbered.
* :func:`rank_all` - the same numbering with no cut-off, one path for every
  size. A plain ``Window.orderBy`` would move every row into a single
  partition, so the rows are range-partitioned on the order, sorted inside
  each partition and written once, each with its range partition and its
  position there. The partition sizes and the output are both read from that
  written copy, so they can't disagree; a rank is the position plus the row
  counts of the partitions before it. The rows cross the network once.
* :func:`top_k_per_group` - ``ROW_NUMBER() OVER (PARTITION BY g ORDER BY ...)
  <= k``; Spark adds a partial WindowGroupLimit before the shuffle, so a hot
  group ships at most ``k`` rows per map task.

Ties: the reference orders by one metric only, leaving ties arbitrary. Callers
pass the group keys as extra ascending keys, which picks one of the orders the
reference allows and makes the result repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def order_spec(metric: str, keys: Sequence[str]) -> list[Column]:
    """``metric DESC NULLS LAST`` then each key ascending, NULLs first."""
    return [F.col(metric).desc_nulls_last()] + [F.col(k).asc_nulls_first() for k in keys]


def top_n(df: DataFrame, order: Sequence[Column], n: int,
          rank_col: str = "rank_num") -> DataFrame:
    best = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)
    return best.withColumn(rank_col, F.row_number().over(w).cast("int"))


def rank_all(df: DataFrame, order: Sequence[Column], rank_col: str = "rank_num",
             num_partitions: int | None = None, folder: str | None = None,
             rank_type: str = "int") -> DataFrame:
    """``df`` plus ``ROW_NUMBER() OVER (ORDER BY order)`` over all rows.

    Runs one job: the sorted rows are written to ``folder`` (default: a fresh
    folder beside the checkpoints)."""
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = folder or scratch_path(spark, "rank")
    part, pos, first = "__range_part", "__range_pos", "__range_first"
    # Every row of range partition i sorts before every row of partition i+1.
    # monotonically_increasing_id holds the partition in its upper bits and
    # the record number of the sorted partition in its lower 33 bits.
    (df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
       .select("*", F.spark_partition_id().alias(part),
               F.monotonically_increasing_id().alias(pos))
       .write.mode("overwrite").parquet(path))
    stored = spark.read.parquet(path)
    # one row per range partition: bounded by num_partitions, safe to broadcast
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    local = F.col(pos) - F.shiftleft(F.col(part).cast("long"), 33) + 1
    return (stored.join(F.broadcast(offsets), part)
                  .withColumn(rank_col, (F.col(first) + local).cast(rank_type))
                  .drop(part, pos, first))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "group_rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("int"))
              .filter(F.col(rank_col) <= k))
