"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every component ``c`` becomes the integer ``floor(scale * c) + offset``. One
pass over the stored integer vectors gives their count, exact per-dimension
sums and the trace of the covariance ``V``.

The leading eigenvectors come from a block ``Q`` of ``count + GUARD`` columns.
The only operation on ``V`` is a distributed pass: every task adds up
``Xc'(Xc Q)`` of its centred rows, the tasks' partial sums are added entry by
entry after a shuffle, and the driver gets a ``dimensions x columns`` matrix. One round applies a Chebyshev polynomial by its
three-term recurrence; the interval it keeps small is ``[0, cut]``, with
``cut`` the smallest Ritz value of the block, so the unwanted spectrum is
damped and the wanted end grows. QR and a Rayleigh-Ritz step follow. Rounds end
when the result is certified: every wanted Ritz pair's residual is below
``TOLERANCE`` of its gap to the other Ritz values, or is at the rounding level.

The block never exceeds the number of dimensions; where it equals it, the first
Rayleigh-Ritz step is already the whole answer.

Cases: rows whose vector is NULL, empty, or holds NULL or non-finite entries
take no part; if lengths differ, the most frequent one is fitted (ties: the
longer) and other rows take no part; a NULL id is kept; repeated rows count as
often as they occur; entries are held within +-2^53; components whose
eigenvalue is zero up to rounding can't be whitened and are not returned, so a
single vector, or equal vectors only, give an empty result, as does an empty
table; equal eigenvalues leave their eigenvectors free; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

GUARD = 20
#: Largest degree of the polynomial.
DEGREE = 12
MAX_ROUNDS = 100
#: The polynomial's largest ratio between both ends of the wanted spectrum.
SPREAD = 1e8
#: Certified error of a component: its residual over its gap.
TOLERANCE = 1e-9
#: Residuals and eigenvalues below this share of the largest are rounding.
ROUNDING = 2e-14
LIMIT = 1 << 53
LONG = (1 << 63) - 1


class Fit(NamedTuple):
    n: int
    sums: list[int]          # per dimension, of the integer vectors
    trace: float             # of the covariance
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # dimensions x components
    rounds: int
    passes: int
    certified: bool


def integer_vectors(vectors: DataFrame, scale: int, offset: int, id_col: str,
                    vector_col: str) -> DataFrame:
    """Stored ``id, x`` (array of ``floor(scale * c)``; ``offset`` is added
    where sums are formed, so that centring stays exact)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(LIMIT - abs(offset))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(
        c * F.lit(float(scale)), F.lit(limit)), F.lit(-limit))).cast("bigint"))
    rows = store(rows.filter((F.size("v") > 0) & ~odd).select("id", x.alias("x")), "whiten")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    most = sizes.first()  # equal lengths: one row
    return rows.filter(F.size("x") == (most["d"] if most else 0))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(name)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), flat.dtype)


def _moments(rows: DataFrame) -> tuple[int, list[int], list[int]]:
    """Count, and exact per-dimension sums and sums of squares."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x")
            if not len(x):
                continue
            wide = x.astype(object) if np.abs(x).max() >= 1 << 20 else x
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(x.shape[1]), pa.int32()),
                "n": pa.array([len(x)] * x.shape[1], pa.int64()),
                "s": pa.array([str(v) for v in wide.sum(0)]),
                "ss": pa.array([str(v) for v in (wide * wide).sum(0)])})

    whole = "decimal(38,0)"
    total = (rows.select("x").mapInArrow(partial, "i int, n long, s string, ss string")
             .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(whole)).alias("s"),
                               F.sum(F.col("ss").cast(whole)).alias("ss")).orderBy("i").collect())
    return (total[0]["n"] if total else 0, [int(r["s"]) for r in total], [int(r["ss"]) for r in total])


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of the tasks' ``i, part`` rows, added up entry by entry."""
    entries = parts.select("i", F.posexplode("part").alias("j", "x"))
    total = entries.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    i, j, x = (total.column(c).to_numpy() for c in ("i", "j", "x"))
    out = np.zeros((i.max() + 1, width))
    out[i, j] = x
    return out


class Covariance:
    """The covariance of stored integer vectors, known by passes over them."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.n, self.sums, squares = _moments(rows)
        self.passes = 0
        n = self.n
        # the mean is a whole part, subtracted exactly, and a rest below one
        self.whole = np.array([s // n for s in self.sums], np.int64)
        self.rest = np.array([(s % n) / n for s in self.sums])
        self.trace = float(sum((n * q - s * s) / n / n for q, s in zip(squares, self.sums, strict=True)))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q`` by one pass."""
        shared = self.rows.sparkSession.sparkContext.broadcast((self.whole, self.rest, q))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole, rest, by = shared.value
            total = None
            for batch in batches:
                x = _matrix(batch, "x")
                if len(x):
                    c = (x - whole) - rest
                    more = c.T @ (c @ by)
                    total = more if total is None else total + more
            if total is not None:
                yield _as_rows(total)

        self.passes += 1
        parts = self.rows.select("x").mapInArrow(partial, "i int, part array<double>")
        return _added(parts, q.shape[1]) / self.n


def _as_rows(total: np.ndarray) -> pa.RecordBatch:
    size = np.arange(0, total.size + 1, total.shape[1], dtype=np.int32)
    return pa.RecordBatch.from_pydict({
        "i": pa.array(np.arange(len(total), dtype=np.int32)),
        "part": pa.ListArray.from_arrays(pa.array(size), pa.array(total.ravel()))})


def chebyshev(times, q: np.ndarray, vq: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """``p(V) q`` with ``p`` the Chebyshev polynomial of ``degree`` on
    ``[0, cut]``, scaled to 1 at ``top``; ``vq`` is ``V q``."""
    centre = half = cut / 2
    sigma = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def certified(values: np.ndarray, residuals: np.ndarray, wanted: int) -> bool:
    """Whether the first ``wanted`` Ritz pairs are accurate: residual over the
    distance to the nearest other Ritz value, or at rounding level."""
    floor = ROUNDING * max(values[0], 0)
    for i in range(wanted):
        gap = np.abs(np.delete(values, i) - values[i]).min(initial=np.inf)
        if residuals[i] > max(TOLERANCE * gap, floor):
            return False
    return True


def leading(v: Covariance, count: int) -> Fit:
    """The first ``count`` eigenpairs of ``v`` (fewer where the rest is zero)."""
    d = len(v.sums)
    wanted, block = min(count, d), min(count + GUARD, d)
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, block)))[0] if block < d else np.eye(d)
    rounds, done = 0, False
    while True:
        w = v.times(q)
        small = q.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        residuals = np.sqrt(((w - q * values) ** 2).sum(0))
        done = block == d or certified(values, residuals, wanted)
        top = values[0]
        done = done or top <= 0
        if done or rounds == MAX_ROUNDS:
            break
        cut = max(values[-1], ROUNDING * top)
        # no higher than double precision can tell the block's columns apart
        degree = int(np.clip(np.log(SPREAD) / np.arccosh(max(2 * top / cut - 1, 1 + 1e-9)), 1, DEGREE))
        q = np.linalg.qr(chebyshev(v.times, q, w, cut, top * (1 + 1e-9), degree))[0]
        rounds += 1
    keep = [i for i in range(wanted) if values[i] > 10 * ROUNDING * max(values[0], 0)]
    return Fit(v.n, v.sums, v.trace, values[keep], q[:, keep], rounds, v.passes, done)


def _identity_error(v: Covariance, project: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    shared = v.rows.sparkSession.sparkContext.broadcast((v.whole, v.rest, project))
    width = project.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, rest, by = shared.value
        total = None
        for batch in batches:
            x = _matrix(batch, "x")
            if len(x):
                z = ((x - whole) - rest) @ by
                z = np.concatenate([z, np.ones((len(z), 1))], 1)  # the last row sums z
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield _as_rows(total)

    total = _added(v.rows.select("x").mapInArrow(partial, "i int, part array<double>"), width + 1)
    mean = total[width, :width] / v.n
    return float(np.abs(total[:width, :width] / v.n - np.outer(mean, mean) - np.eye(width)).max())


def whiten(vectors: DataFrame, count: int = 32, scale: int = 64, offset: int = 1_000_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    per remaining row and component (from 1, by falling eigenvalue)."""
    rows = integer_vectors(vectors, scale, offset, id_col, vector_col)
    out = ("vec_id long, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], out)
    v = Covariance(rows)
    fit = leading(v, count)
    if not fit.certified:
        raise RuntimeError(f"no certified components after {fit.rounds} rounds")
    project = fit.vectors / np.sqrt(fit.values)
    error = _identity_error(v, project) if len(fit.values) else 0.0
    explained = fit.values / fit.trace if fit.trace else fit.values
    n, sums, whole, rest, components = fit.n, fit.sums, v.whole, v.rest, len(fit.values)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x")
            if not len(x) or not components:
                continue
            # n * x - sum, without the offset, which cancels
            safe = n * (float(np.abs(x).max()) + float(np.abs(whole).max()) + 1)
            if safe * safe * x.shape[1] < LONG:
                deviation = ((n * x - np.array(sums, np.int64)) ** 2).sum(1)
            else:
                exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
                deviation = np.array([min(LONG, e) for e in exact], np.int64)
            z = ((x - whole) - rest) @ project
            size = len(x) * components
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(x)), components)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(x))),
                pa.array(np.full(size, n)), pa.array(np.repeat(deviation, components)),
                pa.array(z.ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(size, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(rows_of, out)
