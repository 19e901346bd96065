"""Whitening against a dense eigen-decomposition."""

import numpy as np
import pytest

from martforge.llm import whitening as wt

SCHEMA = "vec_id long, embedding array<double>, id string, x int, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "s", 1, None) for i, v in rows], SCHEMA).repartition(parts)


def dense(rows, count, offset=1_000_000):
    x = np.array([[int(np.floor(64 * c)) + offset for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    centred = ((n * x - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(count, int((values > 1e-12 * values[0]).sum()))
    deviation = ((n * x - sums) ** 2).sum(1)
    return (deviation, centred @ (vectors[:, :keep] / np.sqrt(values[:keep])),
            values[:keep] / values.sum())


def check(spark, rows, count, wide=None):
    got = wt.whiten(frame(spark, rows if wide is None else wide), count).toPandas()
    deviation, z, explained = dense(rows, count)
    assert sorted(zip(got["vec_id"], got["component"])) == sorted(
        (i, c + 1) for i, _ in rows for c in range(z.shape[1]))
    got = got.sort_values(["vec_id", "component"])
    order = np.argsort([i for i, _ in rows], kind="stable")
    mine = got["whitened"].to_numpy().reshape(len(rows), -1)
    want = z[order]
    sign = np.sign((mine * want).sum(0))
    assert np.abs(mine - want * sign).max() < 1e-6
    assert (got["deviation"].to_numpy().reshape(len(rows), -1)[:, 0] == deviation[order].astype(float)).all()
    assert np.allclose(got["explained"].to_numpy().reshape(len(rows), -1), explained, rtol=1e-8)
    assert (got["n"] == len(rows)).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] <= 1e-8


@pytest.mark.parametrize("kind", ["noise", "decaying", "low rank"])
def test_against_dense(spark, monkeypatch, kind):
    monkeypatch.setattr(wt, "GUARD", 4)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 24))
    if kind == "decaying":
        x *= 0.7 ** np.arange(24) * 8
    if kind == "low rank":
        x[:, 5:] = 0
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)], 6)


def test_the_filter_damps_the_unwanted_end():
    values = np.array([9.0, 5.0, 1.0, 0.5, 0.1])
    q = np.ones((5, 1))
    out = np.abs(wt.chebyshev(lambda y: values[:, None] * y, q, values[:, None] * q, 1.0, 9.0, 8)).ravel()
    assert out[0] == pytest.approx(1) and out[1] > 100 * out[2:].max()


def test_small_blocks_take_several_certified_rounds(spark, monkeypatch):
    monkeypatch.setattr(wt, "GUARD", 2)
    rng = np.random.default_rng(8)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 30)))])
    fit = wt.leading(wt.Covariance(wt.integer_vectors(df, 64, 10**6, "vec_id", "embedding")), 5)
    assert fit.certified and fit.rounds > 1 and len(fit.values) == 5
    assert 1 + fit.rounds < fit.passes <= 1 + fit.rounds * wt.DEGREE


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((40, 3)))]
    good += [(40, good[3][1])]  # an equal vector counts again
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0]), (93, [float("nan"), 1.0, 1.0]),
           (94, [float("inf"), 1.0, 1.0]), (95, [1.0, 2.0])]
    check(spark, good, 32, wide=good + bad)
    for rows in ([], bad[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        assert wt.whiten(frame(spark, rows)).count() == 0
    huge = [(None, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 5.0])]
    assert wt.whiten(frame(spark, huge)).filter("deviation = 9223372036854775807").count() > 0
