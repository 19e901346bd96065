"""Exact top-k search against brute force over all pairs."""

import math

import numpy as np
import pytest

from martforge.llm import bitsliced as bs

SCHEMA = "vec_id long, embedding array<double>, id string, v int, score string, query_id int"


def quantised(v, scale=256):
    return [max(-bs.LIMIT, min(bs.LIMIT, math.floor(x * scale))) for x in v]


def brute(rows, k, every):
    rows = sorted({(i, tuple(quantised(v))) for i, v in rows
                   if i is not None and v and None not in v and np.isfinite(v).all()})
    out = {}
    for i, v in rows:
        if i % every == 0:
            scored = {(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j)
                      for j, w in rows if j != i and len(w) == len(v)}
            out.setdefault(i, set()).update(scored)
    return {i: [(j, -s) for s, j in sorted(found)[:k]] for i, found in out.items() if found}


def run(spark, rows, k, every=50, parts=3):
    df = spark.createDataFrame([(i, v, "x", 1, None, 2) for i, v in rows], SCHEMA).repartition(parts)
    out = {}
    for r in bs.top_k(df, df.filter(f"vec_id % {every} = 0"), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_slices_add_up():
    rng = np.random.default_rng(1)
    values = rng.integers(-700, 700, (150, 9))
    block = bs.BitSlicedBlock(np.arange(150), values)
    for query in (rng.integers(-300, 300, 9), np.zeros(9, np.int64), -np.ones(9, np.int64)):
        total = block.summed(query)
        bits = [np.unpackbits(t.view(np.uint8), bitorder="little")[:150].astype(np.int64) for t in total]
        sums = sum((b << w for w, b in enumerate(bits)), np.zeros(150, np.int64))
        exact = values @ query
        assert len(set((sums - exact).tolist())) == 1  # equal but for a constant of the query


@pytest.mark.parametrize("k", [1, 5, 64, 150, 400])
def test_selection_from_the_top_slice_down(k):
    rng = np.random.default_rng(k)
    values = rng.integers(0, 40, 150)  # many ties
    total = list(bs._packed(((values[None] >> np.arange(6)[:, None]) & 1).astype(bool)))
    sure, tied = (bs._rows(x) for x in bs.top_rows(total, bs._packed(np.ones(150, bool)), k))
    if k >= 150:
        assert len(sure) == 150 and not len(tied)
        return
    limit = np.sort(values)[::-1][k - 1]
    assert len(sure) <= k <= len(sure) + len(tied)
    assert set(np.flatnonzero(values > limit)) <= set(sure)
    assert set(tied) <= set(np.flatnonzero(values == limit))


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(12) / 3).tolist()) for i in range(700)]
    rows += [(i, rows[7][1]) for i in range(700, 900)]  # one vector in 200 copies
    want = brute(rows, 5, 50)
    assert run(spark, rows, 5) == want
    monkeypatch.setattr(bs, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bs, "QUERY_BYTES", 500)
    assert run(spark, rows, 5) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (0, [1.0, -2.0]), (0, [0.5, 3.0]), (50, [0.0, 0.0]), (1, [0.0, 0.0]),
            (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (None, [1.0, 1.0]),
            (100, [1.0, 2.0, 3.0]), (101, [-1.0, 0.001, -0.001]), (150, [7.0]),
            (7, [1e300, 1.0]), (8, [-1e300, 1e300]), (200, [1e300, 1e300]), (9, [1.0, -2.0]), (9, [1.0, -2.0])]
    assert run(spark, rows, 3) == brute(rows, 3, 50)
    assert run(spark, [], 3) == {}
    assert run(spark, [(50, [1.0])], 3) == {}
