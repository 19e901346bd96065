"""Packing token sequences by minimum bin slack.

The lengths of all pieces form a histogram of at most ``capacity`` entries,
whatever the number of documents. The plan is made on that histogram: seed a
bin with the longest length left, find by bitset subset-sum dynamic
programming over the remaining lengths the combination that leaves the least
slack, and remove it - as many times at once as the remaining counts allow, so
the work does not grow with the number of documents.

Pieces are then assigned without meeting in one place: every task numbers its
pieces within each length, a cumulative sum over (length, task) counts turns
these into global numbers, and a number falls into one stretch of the plan.

Cases: a document always has at least its end id; repeated rows are packed
each; NULL ids are kept as NULL; an empty table gives no pieces; other columns
are ignored. Lengths tie freely: any piece of a length may take its place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_rows, id_text, slices, store
from .units import encoder

#: Bound of a worker's unit cache; the pieces of a slice need memory beside it.
CACHE_UNITS = 300_000
#: Rows handed to a worker at once, and bytes of their texts cut at once.
BATCH_ROWS = 1500
SLICE_BYTES = 5_000_000
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "task int, place long, ids binary")
PLAN = "length long, first long, last long, used long, bin long, at long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, spaces: str, end_id: int,
               capacity: int) -> DataFrame:
    """Encode every text, append ``end_id`` and cut documents longer than
    ``capacity`` into pieces. ``ids`` holds little-endian uint32; ``place``
    numbers the pieces of equal length within their ``task``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        enc = encoder(tokenizer_path, spaces, limit=CACHE_UNITS)
        seen: dict[int, int] = {}
        end = np.array([end_id], "<u4")
        for batch in slices(batches, size=SLICE_BYTES):
            rows: list[tuple] = []
            numbers = batch.column("doc_id").to_pylist()
            for doc, ids in zip(numbers, enc.ids(batch.column("text")), strict=True):
                ids = np.concatenate([ids, end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    place = seen.get(len(part), 0)
                    seen[len(part)] = place + 1
                    raw = part.tobytes()
                    rows.append((doc, piece, start, len(part), zlib.crc32(raw), task, place, raw))
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                     pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                [c.split()[0] for c in PIECES.split(", ")])

    return id_text(docs).mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the greatest sum not above
    ``room``. Bit ``s`` of ``reach`` says that some combination sums to ``s``;
    lengths are added from long to short until ``room`` itself is reached."""
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:  # multiples by doubling: 1, 2, 4, ... and the rest
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple]:
    """Rows of :data:`PLAN`: the pieces numbered ``first`` to ``last - 1`` of a
    length fill bins from ``bin`` on, ``used`` in each, starting at ``at``."""
    left = {k: v for k, v in histogram.items() if v}
    taken = dict.fromkeys(left, 0)
    rows, first_bin = [], 0
    while left:
        seed = max(left)
        counts = dict(left)
        counts[seed] -= 1
        if not counts[seed]:
            del counts[seed]
        chosen = fullest(counts, capacity - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        times, at = min(left[k] // n for k, n in chosen.items()), 0
        for length, used in sorted(chosen.items(), reverse=True):
            rows.append((length, taken[length], taken[length] + used * times, used, first_bin, at))
            at += used * length
            taken[length] += used * times
            left[length] -= used * times
            if not left[length]:
                del left[length]
        first_bin += times
    return rows


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (stored, with ``length``, ``task`` and ``place``) plus the
    ``sequence_id`` and ``offset`` that the plan gives them."""
    spark = pieces.sparkSession
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = (Window.partitionBy("length").orderBy("task")
               .rowsBetween(Window.unboundedPreceding, -1))
    base = per_task.select("length", "task",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # at most `capacity` rows, and a plan whose size depends on `capacity` only
    histogram = {r["length"]: r["n"] for r in
                 per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan_bins(histogram, capacity)
    plan = spark.createDataFrame(
        pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")], dtype="int64"), PLAN)
    number = F.col("base") + F.col("place")
    numbered = pieces.join(base, ["length", "task"]).withColumn("number", number)
    inside = ((numbered["length"] == plan["length"]) & (F.col("number") >= F.col("first"))
              & (F.col("number") < F.col("last")))
    nth = F.col("number") - F.col("first")
    return (numbered.join(F.broadcast(plan), inside)
            .withColumn("sequence_id", F.col("bin") + F.floor(nth / F.col("used")))
            .withColumn("offset", F.col("at") + nth % F.col("used") * numbered["length"])
            .select(*(numbered[c] for c in pieces.columns), "sequence_id", "offset"))


def sequences(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids binary``. ``placed``
    comes from :func:`place_pieces`, ``ids`` holds (task, length, place, ids)."""
    joined = placed.join(ids.select("task", "length", "place", "ids"),
                         ["task", "length", "place"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack(docs: DataFrame, tokenizer_path: str, spaces: str, end_id: int,
         capacity: int) -> tuple[DataFrame, DataFrame]:
    """``(placed pieces, pieces with their ids)``."""
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        pieces = store(cut_pieces(docs, tokenizer_path, spaces, end_id, capacity), "pieces")
    return place_pieces(pieces.drop("ids"), capacity), pieces
