"""Exact top-k search by integer inner product on a bit-sliced index.

Every component ``x`` of a vector becomes the integer ``floor(scale * x)``, an
attribute of the row. A task indexes its rows in blocks of ``BLOCK_ROWS``: per
attribute the values less their block minimum, bit by bit, one packed bitmap
of all rows for each bit.

A query adds the slices of all attributes by bitmap arithmetic. A weight
``q_j`` is a sum of powers of two, so attribute ``j`` gives its slices once for
each of those powers; for a negative weight the slices are complemented
(``2^b - 1 - value``), which keeps every term non-negative and changes the sum
by a constant of the query. The slices of one power are summed three at a time
by full adders, whose carries go on to the next power. What is left is the
bit-sliced sum of the block, exact for every row.

Selection runs from the most significant slice downward: ``sure`` holds rows
that are above the k-th score, ``open`` those that agree with it so far. Rows
still open after the last slice tie on the boundary and are resolved by their
exact score and id (blocks are sorted by id). Scores of the selected rows are
computed from the integers.

Queries are broadcast in blocks of at most ``QUERY_BYTES``; vectors are dealt
by id into tasks, and only each task's k best per query go on to the merge.

Cases: rows whose id or vector is NULL, or whose vector is empty or holds NULL
or non-finite components take no part (zero vectors do); a query sees only
vectors of its own length; equal rows count once, a query's own id is never
its candidate; ties go to the smaller id; fewer candidates than ``k`` are all
returned; integers are held within +-2^53 and scores within the range of long;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

BLOCK_ROWS = 8192
QUERY_BYTES = 32 << 20
FOUND = "query_id long, vec_id long, score long"
LIMIT = 1 << 53
LONG = (1 << 63) - 1


def _packed(bits: np.ndarray) -> np.ndarray:
    """``(..., rows)`` booleans as bitmaps of 64-bit words."""
    n = -(-bits.shape[-1] // 64) * 64
    wide = np.zeros(bits.shape[:-1] + (n,), bool)
    wide[..., : bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def add_slices(terms: list[np.ndarray], words: int) -> list[np.ndarray]:
    """Bit slices of the sum, least significant first; ``terms[w]`` is a stack
    of bitmaps that each count ``2^w``."""
    total, carried, w = [], [], 0
    while w < len(terms) or carried:
        stack = np.concatenate([*terms[w:w + 1], *carried])
        carried = []
        while len(stack) > 2:  # full adders: three bitmaps -> sum and carry
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
            half = a ^ b
            carried.append((a & b) | (half & c))
            stack = np.concatenate([half ^ c, stack[3 * third:]])
        if len(stack) == 2:
            carried.append((stack[0] & stack[1])[None])
            stack = (stack[0] ^ stack[1])[None]
        total.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        carried = [c for c in carried if len(c)]
        w += 1
    return total


def top_rows(total: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sure, open)``: rows of ``among`` whose sum is above the k-th largest,
    and those that equal it; all of them if there are at most ``k``."""
    sure, open_ = np.zeros_like(among), among
    if _count(among) <= k:
        return among, sure
    for bitmap in reversed(total):
        more = open_ & bitmap
        n = _count(sure) + _count(more)
        if n > k:
            open_ = more
        else:
            sure, open_ = sure | more, open_ & ~bitmap
            if n == k:
                return sure, np.zeros_like(sure)
    return sure, open_


class BitSlicedBlock:
    """Index over at most ``BLOCK_ROWS`` rows of one vector length."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.lexsort((*values.T[::-1], ids))
        ids, values = ids[order], values[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (values[1:] != values[:-1]).any(1)
        self.ids, self.values = ids[new], values[new]
        self.low = self.values.min(0)
        above = (self.values - self.low).astype(np.uint64)
        self.all = _packed(np.ones(len(self.ids), bool))
        stacks, owner, place = [np.zeros((0, len(self.all)), np.uint64)], [], []
        for j, column in enumerate(above.T):
            depth = int(column.max()).bit_length()
            bits = (column[None, :] >> np.arange(depth, dtype=np.uint64)[:, None]) & np.uint64(1)
            stacks.append(_packed(bits.astype(bool)))
            owner += [j] * depth
            place += range(depth)
        up = np.concatenate(stacks)
        self.slices = np.concatenate([up, ~up & self.all])  # values, then their complements
        self.owner, self.place = np.array(owner, np.int64), np.array(place, np.int64)
        self.widest = int(np.abs(self.values).max())

    def summed(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of ``score + constant`` for every row of the block."""
        weight = np.abs(query)[self.owner]
        at = np.arange(len(self.owner)) + np.where(query[self.owner] < 0, len(self.owner), 0)
        powers = int(np.abs(query).max(initial=0)).bit_length()
        terms = []
        for w in range(powers + int(self.place.max(initial=0))):
            shift = w - self.place  # the power of the weight that lifts a slice to 2^w
            uses = (shift >= 0) & ((weight >> np.clip(shift, 0, 62)) & 1 == 1)
            terms.append(self.slices[at[uses]])
        return add_slices(terms, len(self.all))

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the rows that may be among the ``k`` best."""
        among = self.all
        own = slice(*np.searchsorted(self.ids, [query_id, query_id + 1]))
        if own.start < own.stop:
            mask = np.zeros(len(self.ids), bool)
            mask[own] = True
            among = among & ~_packed(mask)
        sure, tied = top_rows(self.summed(query), among, k)
        rows = np.concatenate([_rows(sure), _rows(tied)[: k - _count(sure)]])
        if len(query) * self.widest * int(np.abs(query).max(initial=0)) < LONG:
            return self.ids[rows], self.values[rows] @ query
        exact = self.values[rows].astype(object) @ query.astype(object)
        return self.ids[rows], np.array([max(-LONG - 1, min(LONG, s)) for s in exact], np.int64)


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, v array<bigint>`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = F.transform("v", lambda x: F.floor(F.greatest(F.least(
        x * F.lit(float(scale)), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("bigint"))
    return rows.filter(F.col("id").isNotNull() & (F.size("v") > 0) & ~odd).select("id", held.alias("v"))


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of a batch, by vector length."""
    lists = batch.column("v")
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        mine = np.flatnonzero(size == d)
        yield ids[mine], flat[start[mine][:, None] + np.arange(d)]


def _merged(kept: tuple, more: tuple, k: int) -> tuple:
    ids, score = (np.concatenate(x) for x in zip(kept, more, strict=True))
    order = np.lexsort((ids, -score))
    ids, score = ids[order], score[order]
    new = np.ones(len(ids), bool)  # rows alike in id and score count once in the result
    new[1:] = (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    return ids[new][:k], score[new][:k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer
    inner products with the rows of ``vectors`` other than its own."""
    spark = vectors.sparkSession
    asked = store(quantised(queries, scale, id_col, vector_col).distinct(), "bsi-queries")
    size = asked.agg(F.sum(F.size("v") * 8 + 8), F.count(F.lit(1))).first()
    rows = quantised(vectors, scale, id_col, vector_col)
    n_tasks = max(1, math.ceil(vectors.count() / BLOCK_ROWS))
    if n_tasks > 1:
        rows = rows.repartition(n_tasks, "id")
    n_blocks = max(1, math.ceil((size[0] or 0) / QUERY_BYTES))
    if n_blocks > 1:
        rows = store(rows, "bsi-rows")
    found = []
    for number in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)) == number).toArrow()
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in block.combine_chunks().to_batches():
            for ids, matrix in _arrays(batch):
                by_size.setdefault(matrix.shape[1], []).extend(zip(ids.tolist(), matrix, strict=True))
        shared = spark.sparkContext.broadcast(by_size)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted = shared.value
            none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            state = {d: [none] * len(wanted[d]) for d in wanted}
            held: dict[int, list] = {d: [] for d in wanted}

            def run(d: int) -> None:
                if held[d]:
                    ids, values = (np.concatenate(x) for x in zip(*held[d], strict=True))
                    held[d] = []
                    for at in range(0, len(ids), BLOCK_ROWS):
                        part = BitSlicedBlock(ids[at:at + BLOCK_ROWS], values[at:at + BLOCK_ROWS])
                        for i, (query_id, query) in enumerate(wanted[d]):
                            state[d][i] = _merged(state[d][i], part.best(query_id, query, k), k)

            for batch in batches:
                for ids, matrix in _arrays(batch):
                    d = matrix.shape[1]
                    if d in held:
                        held[d].append((ids, matrix))
                        if sum(len(i) for i, _ in held[d]) >= BLOCK_ROWS:
                            run(d)
            for d in wanted:
                run(d)
                for (query_id, _), (ids, score) in zip(wanted[d], state[d], strict=True):
                    if len(ids):
                        yield pa.RecordBatch.from_pydict({
                            "query_id": pa.array(np.full(len(ids), query_id), pa.int64()),
                            "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})

        found.append(rows.mapInArrow(search, FOUND))
        if n_blocks > 1:
            found[-1] = store(found[-1], "bsi-found")
    parts = found[0]
    for part in found[1:]:
        parts = parts.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (parts.dropDuplicates(["query_id", "vec_id", "score"])
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
