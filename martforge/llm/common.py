"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that a worker handles at once.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder beside the shared checkpoints and read it
    back: the rows are computed once and lineage ends there, so a lost
    executor costs a re-read rather than a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs run inside hand at most ``n`` rows at a time to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of ``batches`` in order, in slices whose texts hold about
    ``size`` bytes (at least one row each): what a worker makes of a slice is
    freed before the next, so its memory does not grow with the batches."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
        number = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield batch.slice(a, b - a)


def unused(columns: list[str], *wanted: str) -> list[str]:
    """The names ``wanted``, each with as many underscores before it as it
    takes to differ from all of ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` with NULL text read as empty; all other
    columns are dropped, so their names can't clash with internal ones."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def chunks(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts holding about ``chars`` characters
    (at least one text each), so per-chunk token lists stay small."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
