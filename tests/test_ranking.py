"""Distributed rankings against the plain single-partition window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.functions.ranking import order_spec, rank_all, top_k_per_group, top_n


def _frame(spark, n=5000):
    # many ties on the metric, a unique key to break them
    return spark.range(n).select(F.col("id").cast("string").alias("k"),
                                 (F.col("id") % 37).cast("decimal(14,2)").alias("m"))


def _reference(df, order):
    return df.withColumn("rank_num", F.row_number().over(Window.orderBy(*order)).cast("int"))


def test_rank_all_matches_window(spark):
    df = _frame(spark)
    order = order_spec("m", ["k"])
    got = rank_all(df, order, num_partitions=7)
    exp = _reference(df, order)
    assert got.count() == 5000
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_rank_all_with_nulls_and_one_partition(spark):
    df = _frame(spark, 300).withColumn(
        "m", F.when(F.col("k").cast("int") % 10 == 0, None).otherwise(F.col("m")))
    order = order_spec("m", ["k"])
    got = rank_all(df, order, num_partitions=1)
    exp = _reference(df, order)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    last = got.orderBy(F.col("rank_num").desc()).first()
    assert last.m is None  # DESC puts NULL last


def test_top_n_matches_window(spark):
    df = _frame(spark)
    order = order_spec("m", ["k"])
    got = top_n(df, order, 100)
    exp = _reference(df, order).filter("rank_num <= 100")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_top_k_per_group(spark):
    df = _frame(spark).withColumn("g", F.col("k").cast("int") % 3)
    got = top_k_per_group(df, ["g"], order_spec("m", ["k"]), 3)
    assert got.count() == 9
    assert got.groupBy("g").agg(F.max("group_rank").alias("x")).filter("x != 3").count() == 0


@pytest.mark.parametrize("n", [5_000, 200_000])
@pytest.mark.parametrize("parts", [7, 16])
def test_rank_all_with_payload_columns(spark, n, parts):
    df = _frame(spark, n).withColumn("pay1", F.md5("k")).withColumn("pay2", F.length("k"))
    order = order_spec("m", ["k"])
    got = rank_all(df.repartition(5), order, num_partitions=parts)
    exp = _reference(df, order)
    assert got.join(exp, ["k", "m", "pay1", "pay2", "rank_num"], "left_semi").count() == n
    span = got.agg(F.min("rank_num"), F.max("rank_num"), F.countDistinct("rank_num")).first()
    assert tuple(span) == (1, n, n)


def test_rank_all_empty(spark):
    assert rank_all(_frame(spark, 0), order_spec("m", ["k"])).count() == 0


def test_rank_all_hot_metric_value_is_split(spark):
    # a third of the rows share one metric value; the order includes the
    # unique key, so the range bounds cut through the tie
    df = _frame(spark, 6000).withColumn(
        "m", F.when(F.col("k").cast("int") % 3 == 0, F.lit(5).cast("decimal(14,2)"))
              .otherwise(F.col("m")))
    order = order_spec("m", ["k"])
    got = rank_all(df, order, num_partitions=6)
    exp = _reference(df, order)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    ranged = got.repartitionByRange(6, *order)  # same bounds rule
    sizes = [r["n"] for r in ranged.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 6000 / 3, sizes
