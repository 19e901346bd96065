"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from martforge.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<double>, id string, v int, score string"


def brute(rows, k):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v
                   and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            scored = sorted((-(np.array(v) * np.array(w)).sum(), j) for j, w in rows
                            if j != i and len(w) == len(v))[:k]
            out[i] = [(j, -s) for s, j in scored]
    return out


def run(spark, rows, k, parts=3):
    df = spark.createDataFrame([(i, v, "x", 1, None) for i, v in rows], SCHEMA).repartition(parts)
    out = {}
    for r in nn.nearest(df, df.filter("vec_id % 20 = 0"), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_chi_square_quantile():
    assert nn.chi_square_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)
    assert nn.chi_square_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)


def test_leaves_cover_all_points_once():
    points = np.random.default_rng(0).standard_normal((1000, 4))
    points[:400] = points[0]
    leaves = nn.kd_leaves(points, 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000))
    assert max(map(len, leaves)) <= 16


def test_projections_follow_chi_square():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 32))
    block = nn.Block(np.arange(4000), x, 3)
    lifted = np.concatenate([block.vectors, np.sqrt(block.top - (block.vectors ** 2).sum(1))[:, None]], 1)
    step = lifted[1:] - lifted[:-1]
    ratio = ((step @ block.axes) ** 2).sum(1) / (step ** 2).sum(1)
    assert np.mean(ratio < nn.chi_square_quantile(0.5, nn.DIMENSIONS)) == pytest.approx(0.5, abs=0.05)


@pytest.mark.parametrize("kind", ["normal", "clustered", "unit"])
def test_recall(spark, monkeypatch, kind):
    monkeypatch.setattr(nn, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(nn, "QUERY_BYTES", 70 * 8 * 24)
    monkeypatch.setattr(nn, "QUERY_SLICE", 30)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 24))
    if kind == "clustered":
        x = x * 0.2 + rng.standard_normal((20, 24))[rng.integers(0, 20, 4000)]
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = run(spark, rows, 20), brute(rows, 20)
    assert got.keys() == want.keys()
    hits = [len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]
    assert np.mean(hits) >= 0.95
    exact = {(i, j): s for i in want for j, s in want[i]}
    assert all(s == exact[i, j] for i in got for j, s in got[i] if (i, j) in exact)
    assert all(len(v) == 20 for v in got.values())


@pytest.mark.parametrize("size", [4000, 16000])
def test_the_stop_prunes_clustered_vectors(size):
    rng = np.random.default_rng(size)
    x = rng.standard_normal((60, 48))[rng.integers(0, 60, size)] + 0.2 * rng.standard_normal((size, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    asked = np.arange(0, size, 20)
    block = nn.Block(np.arange(size), x, 20)
    which = block.search(x[asked], np.full(len(asked), -np.inf), 20,
                         nn.chi_square_quantile(nn.CONFIDENCE, nn.DIMENSIONS))
    q, ids, score = nn._best(*block.candidates(asked, x[asked], which), 20)
    exact = x[asked] @ x.T
    exact[np.arange(len(asked)), asked] = -np.inf
    kth = np.sort(exact, axis=1)[:, -20]
    recall = np.mean(exact[q, ids] >= kth[q] - 1e-12)
    assert len(q) == 20 * len(asked) and recall >= 0.95
    assert block.verified <= 0.3 * size * len(asked)
    again = nn.Block(np.arange(size), x, 20)  # a bound from elsewhere prunes further
    again.search(x[asked], kth, 20, nn.chi_square_quantile(nn.CONFIDENCE, nn.DIMENSIONS))
    assert again.verified < block.verified


def test_uniform_directions_leave_little_to_prune():
    x = np.random.default_rng(3).standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    block = nn.Block(np.arange(4000), x, 20)
    block.search(x[:200], np.full(200, -np.inf), 20, nn.chi_square_quantile(nn.CONFIDENCE, nn.DIMENSIONS))
    assert block.verified <= 0.98 * 200 * 4000


def test_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    same, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(i, same) for i in range(0, 60)]  # ties beyond k
    rows += [(100 + i, rng.standard_normal(3).tolist()) for i in range(50)]
    rows += [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 2.0]),
             (280, [nan, 1.0, 1.0]), (281, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
             (300, [1.0, 2.0]), (301, [2.0, 1.0]), (0, same), (0, same), (120, same)]
    assert run(spark, rows, 7) == brute(rows, 7)
    monkeypatch.setattr(nn, "BLOCK_ROWS", 16)
    assert run(spark, rows, 7) == brute(rows, 7)
    assert run(spark, [(40, [1.0, 1.0]), (41, [2.0, 1.0]), (42, [0.0, -1.0])], 7) == {
        40: [(41, 3.0), (42, -1.0)]}
    assert run(spark, [], 7) == {}
