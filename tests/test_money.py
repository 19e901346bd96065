"""Decimal rounding helpers against exact Python decimal arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from martforge.functions.money import percent, ratio


def test_ratio_and_percent_round_half_up(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(20000):
        cents = rnd.randrange(-10**11, 10**11)
        n = rnd.choice([0, 1, 2, 3, 4, 7, 8, 16, rnd.randrange(1, 10**6)])
        rows.append((Decimal(cents).scaleb(-2), n))
    # exact half-cent cases
    rows += [(Decimal("288175.47"), 2), (Decimal("0.05"), 2), (Decimal("-0.05"), 2),
             (Decimal("1.25"), 2), (Decimal("-1.25"), 2)]
    df = spark.createDataFrame(rows, "amt decimal(14,2), n long")
    got = df.select("amt", "n",
                    ratio("amt", "n", 2, None).cast("decimal(38,2)").alias("r"),
                    percent("amt", F.col("n").cast("decimal(20,0)") * F.lit(1000), dtype=None)
                    .cast("decimal(38,2)").alias("p")).collect()
    bad = []
    for amt, n, r, p in got:
        exp_r = None if n == 0 else (amt / Decimal(n)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        exp_p = None if n == 0 else (amt * 100 / (Decimal(n) * 1000)).quantize(
            Decimal("0.01"), ROUND_HALF_UP)
        if r != exp_r or p != exp_p:
            bad.append((amt, n, r, exp_r, p, exp_p))
    assert not bad, bad[:5]
