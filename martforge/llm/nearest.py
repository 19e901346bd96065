"""Approximate nearest neighbours by low-dimensional stable projections.

Largest inner product becomes smallest distance by one more coordinate: with
``M`` the largest norm of a block, ``x' = (x, sqrt(M^2 - |x|^2))`` and
``q' = (q, 0)`` give ``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``. A Gaussian
(2-stable) projection to ``m`` dimensions keeps distances in distribution: the
ratio of squared projected to squared true distance is chi-square with ``m``
degrees of freedom.

Every task indexes blocks of at most ``BLOCK_ROWS`` of its vectors: projections
in the leaves of a kd-tree. A query takes the leaves by their distance in the
projected space, in waves of growing size, and verifies their vectors exactly.
A leaf is left out, and the search stops at the first wave with no leaf left,
once a vector nearer than the query's k-th best would by now have appeared with
probability ``CONFIDENCE``: when no point of the leaf is within the chi-square
quantile times the squared k-th distance. Each leaf is verified for all its
queries in one product, and a block starts from the k-th best of the blocks
before it.

How much that prunes is a property of the vectors. Where neighbours are much
nearer than the rest, as in clustered embeddings, a small share is verified;
where all distances are alike (uniform directions in many dimensions) no
projection to few dimensions can tell neighbours apart, and most of a block is
verified. ``Block.verified`` counts it; the README has figures.

Queries are broadcast in blocks of at most ``QUERY_BYTES`` and searched
``QUERY_SLICE`` at a time; only each task's k best per query go on to the merge.

Cases: rows whose id or vector is NULL, or whose vector is empty, zero or holds
NULL or non-finite components take no part; a query sees only vectors of its
own length; equal rows count once, equal vectors under different ids are all
candidates and tie to the smaller id; fewer candidates than ``k`` are all
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

DIMENSIONS = 8
CONFIDENCE = 0.95
LEAF = 32
BLOCK_ROWS = 16_384
#: Vectors a task gets at least, however many tasks could run.
TASK_ROWS = 4096
QUERY_BYTES = 16 << 20
QUERY_SLICE = 4096
#: Leaves of a wave as a multiple of those before it.
WAVE = 3
#: Further classes kept beside the k best, against rounding in the products.
SPARE = 8
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, m: int) -> float:
    """Quantile of chi-square with an even number ``m`` of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: cells are halved at the median
    of their widest dimension."""
    waiting, leaves = [np.arange(len(points))], []
    while waiting:
        rows = waiting.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        mine = points[rows]
        along = mine[:, np.argmax(mine.max(0) - mine.min(0))]
        order, half = np.argpartition(along, len(rows) // 2), len(rows) // 2
        waiting += [rows[order[:half]], rows[order[half:]]]
    return leaves


class Block:
    """Distinct vectors of one length with their smallest ids, indexed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        as_bytes = np.ascontiguousarray(vectors).view(f"V{8 * vectors.shape[1]}").ravel()
        _, first, group = np.unique(as_bytes, return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        pairs = np.unique(np.stack([group.ravel(), ids], 1), axis=0)  # by class, then id
        start = np.searchsorted(pairs[:, 0], np.arange(len(first)))
        place = np.arange(len(pairs)) - start[pairs[:, 0]]
        keep = place <= k  # k and one more, as the query's own id doesn't count
        self.ids = np.full((len(first), int(place[keep].max()) + 1), -1, np.int64)
        self.used = np.zeros(self.ids.shape, bool)
        self.ids[pairs[keep, 0], place[keep]] = pairs[keep, 1]
        self.used[pairs[keep, 0], place[keep]] = True
        norms = (self.vectors ** 2).sum(1)
        self.top = norms.max()
        lifted = np.concatenate([self.vectors, np.sqrt(self.top - norms)[:, None]], 1)
        self.axes = np.random.default_rng(lifted.shape[1]).standard_normal(
            (lifted.shape[1], DIMENSIONS))
        self.points = lifted @ self.axes
        self.leaves = kd_leaves(self.points)
        self.low = np.array([self.points[rows].min(0) for rows in self.leaves])
        self.high = np.array([self.points[rows].max(0) for rows in self.leaves])
        self.verified = 0  # pairs of a query and a vector

    def search(self, queries: np.ndarray, bound: np.ndarray, k: int, quantile: float):
        """Best ``k + 1 + SPARE`` classes per query (-1: none); ``bound`` is the
        k-th best score that is known from elsewhere."""
        parts = [self._search(queries[at:at + QUERY_SLICE], bound[at:at + QUERY_SLICE], k, quantile)
                 for at in range(0, len(queries), QUERY_SLICE)]
        return np.concatenate(parts)

    def _search(self, queries: np.ndarray, bound: np.ndarray, k: int, quantile: float):
        n, width = len(queries), k + 1 + SPARE
        at = queries @ self.axes[:-1]
        gap = np.zeros((n, len(self.leaves)))
        for j in range(DIMENSIONS):
            x = at[:, j, None]
            gap += np.maximum(np.maximum(self.low[None, :, j] - x, x - self.high[None, :, j]), 0) ** 2
        place = np.argsort(np.argsort(gap, axis=1, kind="stable"), axis=1)
        wave = np.zeros(gap.shape, np.int8)
        for ends in WAVE ** np.arange(1, 40):
            wave += place >= ends
            if ends > len(self.leaves):
                break
        best, which = np.full((n, width), -np.inf), np.full((n, width), -1)
        reach = np.full(n, np.inf)  # squared projected distance that still matters
        norms = (queries ** 2).sum(1)

        def within(rows: np.ndarray) -> np.ndarray:
            kth = np.maximum(bound[rows], best[rows, k])  # own class may be among them
            return quantile * np.maximum(norms[rows] + self.top - 2 * kth, 0)

        reach = within(np.arange(n))
        for turn in range(int(wave.max(initial=0)) + 1):
            todo = (wave == turn) & (gap <= reach[:, None])
            if not todo.any():
                break
            for leaf in np.flatnonzero(todo.any(0)).tolist():
                rows = self.leaves[leaf]
                members = np.flatnonzero(todo[:, leaf] & (gap[:, leaf] <= reach))
                near = ((self.points[rows] ** 2).sum(1) - 2 * at[members] @ self.points[rows].T).min(1) \
                    + (at[members] ** 2).sum(1)
                members = members[near <= reach[members] * (1 + 1e-9)]
                if not len(members):
                    continue
                scores = queries[members] @ self.vectors[rows].T
                self.verified += scores.size
                better = scores.max(1) > best[members, -1]
                members, scores = members[better], scores[better]
                if not len(members):
                    continue
                both = np.concatenate([best[members], scores], 1)
                names = np.concatenate([which[members], np.broadcast_to(rows, scores.shape)], 1)
                pick = np.argpartition(-both, width - 1, axis=1)[:, :width]
                both, names = np.take_along_axis(both, pick, 1), np.take_along_axis(names, pick, 1)
                rank = np.argsort(-both, axis=1, kind="stable")
                best[members] = np.take_along_axis(both, rank, 1)
                which[members] = np.take_along_axis(names, rank, 1)
                reach[members] = within(members)
        return which

    def candidates(self, query_ids: np.ndarray, queries: np.ndarray, which: np.ndarray):
        """``(query number, id, score)`` of the found classes' rows, scores
        summed the same way wherever a vector lies."""
        q, slot = np.nonzero(which >= 0)
        group = which[q, slot]
        score = (queries[q] * self.vectors[group]).sum(1)
        member, place = np.nonzero(self.used[group])
        q, ids, score = q[member], self.ids[group[member], place], score[member]
        other = ids != query_ids[q]
        return q[other], ids[other], score[other]


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The k best per query number, best first, ties to smaller ids."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    q, ids, score = q[new], ids[new], score[new]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], ids[keep], score[keep]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v array<double>`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd
                       & F.exists("v", lambda x: x != 0))


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, by vector length."""
    lists = batch.column("v")
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        mine = np.flatnonzero(size == d)
        yield ids[mine], flat[start[mine][:, None] + np.arange(d)]


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best found among
    the rows of ``vectors`` other than its own."""
    spark = vectors.sparkSession
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col).distinct()
    n = vectors.count()
    # as many tasks as can run at once, if each still gets enough vectors to index
    share = math.ceil(n / (2 * spark.sparkContext.defaultParallelism))
    n_tasks = max(1, math.ceil(n / min(BLOCK_ROWS, max(TASK_ROWS, share))))
    if n_tasks > 1:
        rows = rows.repartition(n_tasks, "id")
    asked = store(asked, "queries")
    size = asked.agg(F.sum(F.size("v") * 8 + 8)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / QUERY_BYTES))
    if n_blocks > 1:
        rows = store(rows, "vectors")
    quantile = chi_square_quantile(CONFIDENCE, DIMENSIONS)
    found = None
    for number in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)) == number).toArrow()
        by_size: dict[int, tuple] = {}
        for batch in block.combine_chunks().to_batches():
            for ids, matrix in _arrays(batch):
                by_size[matrix.shape[1]] = (ids, matrix)
        shared = spark.sparkContext.broadcast(by_size)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted = shared.value
            state = {d: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                     for d in wanted}
            held: dict[int, list] = {d: [] for d in wanted}

            def run(d: int) -> None:
                if not held[d]:
                    return
                query_ids, matrix = wanted[d]
                part = Block(np.concatenate([i for i, _ in held[d]]),
                             np.concatenate([v for _, v in held[d]]), k)
                held[d] = []
                q, ids, score = state[d]
                bound = np.full(len(matrix), -np.inf)
                full = np.bincount(q, minlength=len(matrix)) == k
                last = np.searchsorted(q, np.arange(len(matrix)), side="right") - 1
                bound[full] = score[last[full]]
                more = part.candidates(query_ids, matrix, part.search(matrix, bound, k, quantile))
                state[d] = _best(*(np.concatenate(x) for x in zip(state[d], more, strict=True)), k)

            for batch in batches:
                for ids, matrix in _arrays(batch):
                    d = matrix.shape[1]
                    if d in held:
                        held[d].append((ids, matrix))
                        if sum(len(i) for i, _ in held[d]) >= BLOCK_ROWS:
                            run(d)
            for d in wanted:
                run(d)
                q, ids, score = state[d]
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(wanted[d][0][q], pa.int64()),
                    "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})

        part = rows.mapInArrow(search, FOUND)
        if n_blocks > 1:
            part = store(part, "found")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # equal rows that lie in different tasks count once
    return (found.dropDuplicates(["query_id", "vec_id", "score"])
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
