"""Token counts by a map-side two-tier lookup.

1. Every task keeps the most frequent pre-token units of its rows in a bounded
   table; the tasks' tables are merged, a bounded number at a time, into one
   table of at most ``table_size`` units. Only these per-task summaries move,
   never the units of the texts.
2. The units' token counts, taken from the tokenizer library, are broadcast as
   a compact table (its size is bounded by ``table_size`` and ``MAX_UNIT``).
3. Each worker counts a text as the sum over its units: first tier the
   broadcast table, second tier the worker's own bounded cache, which encodes
   a missing unit with the library.

The table and the caches only save time: counts are exact whatever they hold.

Cases: NULL or empty text counts 0 bytes and 0 tokens; repeated rows are
counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, store
from .units import CHUNK_BYTES, UnitEncoder, encoder, split_units

TABLE_SIZE = 65_536
#: Longer units are left to the worker caches.
MAX_UNIT = 48
MERGE_AT_ONCE = 16

_KNOWN: dict[str, dict] = {}


def _pack(counts: Counter) -> bytes:
    return zlib.compress(json.dumps(dict(counts)).encode())


def _unpack(blob: bytes) -> dict:
    return json.loads(zlib.decompress(blob))


def frequent_units(texts: DataFrame, spaces: str, table_size: int = TABLE_SIZE) -> list[str]:
    """The most frequent units of all rows, by merging bounded summaries."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen: Counter = Counter()
        for batch in batches:
            column = batch.column("text")
            step = max(1, len(column) * CHUNK_BYTES // max(1, column.nbytes))
            for at in range(0, len(column), step):
                units = split_units(column.slice(at, step), spaces).flatten()
                found = pc.value_counts(units)
                size = found.field("counts").to_numpy()
                keep = min(len(size), table_size)
                top = np.argpartition(-size, keep - 1)[:keep] if keep else []
                names = found.field("values").take(pa.array(top, pa.int64())).to_pylist()
                for name, n in zip(names, size[top].tolist(), strict=True):
                    if len(name) <= MAX_UNIT:
                        seen[name] += n
                if len(seen) > 4 * table_size:
                    seen = Counter(dict(seen.most_common(2 * table_size)))
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array([TaskContext.get().partitionId()], pa.int64()),
             "summary": [_pack(Counter(dict(seen.most_common(table_size))))]})

    def merge(pdf):
        import pandas as pd

        total: Counter = Counter()
        for blob in pdf["summary"]:
            total.update(_unpack(blob))
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0]) // MERGE_AT_ONCE],
                             "summary": [_pack(Counter(dict(total.most_common(table_size))))]})

    schema = "slot long, summary binary"
    summaries = store(texts.select("text").mapInArrow(summarize, schema), "unit-summaries")
    slots = summaries.agg(F.max("slot")).first()[0]
    while slots is not None and slots >= MERGE_AT_ONCE:
        summaries = (summaries.groupBy((F.col("slot") / MERGE_AT_ONCE).cast("long"))
                     .applyInPandas(merge, schema))
        slots //= MERGE_AT_ONCE
    total: Counter = Counter()
    for row in summaries.collect():  # at most MERGE_AT_ONCE bounded summaries
        total.update(_unpack(row["summary"]))
    return [u for u, _ in total.most_common(table_size)]


def token_counts(docs: DataFrame, tokenizer_path: str, spaces: str, limit: int,
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``
    (``doc_id``, ``text``). ``spaces`` says whether the tokenizer drops or
    keeps white space (see :mod:`martforge.llm.units`)."""
    spark = docs.sparkSession
    rows = id_text(docs)
    frequent = frequent_units(rows, spaces, table_size)
    lookup = UnitEncoder(tokenizer_path, spaces, counts=True)
    table = spark.sparkContext.broadcast(zlib.compress(json.dumps(
        {u: lookup.encode_unit(u) for u in frequent}).encode()))
    key = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, spaces, counts=True)
        if key not in _KNOWN:  # unpacked once per worker
            _KNOWN.clear()
            _KNOWN[key] = json.loads(zlib.decompress(table.value))
        enc.known = _KNOWN[key]
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
                "n_tokens": pa.array(enc.count(batch.column("text")), pa.int64())})

    counted = (rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
               .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
