"""Token-id files in patched frame-of-reference blocks.

The ids of all documents form one stream in ascending ``doc_id`` order, cut
into shards (range partitions) and segments. A segment is one self-contained
file image, stored as a row of a Parquet data set so that it lies in whatever
store Spark writes to:

    magic "PFR1", block size u32, ids u64, blocks u32, width percentile u8
    block starts u32 each (byte positions within the data part), end u32
    per block: minimum u32, width u8, exceptions u16,
               packed low bits, exception positions u16, exception values u32

A block subtracts its minimum and packs the differences at the width that
holds ``percentile`` per cent of them; larger ones are exceptions, listed with
position and full difference. The block starts allow any slice of a segment to
be read without decoding the blocks before it.

Cases: NULL or empty text holds the end id only; rows with equal or NULL ids
are kept, NULL first, equal ids in table order; an empty table gives no files;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, store
from .units import encoder

MAGIC, HEADER = b"PFR1", struct.Struct("<4sIQIB")
BLOCK = struct.Struct("<IBH")
BLOCK_IDS = 1024
PERCENTILE = 95
#: A segment is closed once it holds this many ids.
SEGMENT_IDS = 1 << 19
FILES = ("shard int, segment int, start long, n_ids long, doc_ids array<long>, "
         "doc_lengths array<long>, image binary")


def packed_size(n: int, width: int) -> int:
    """Bytes that ``n`` values of ``width`` bits take."""
    return 8 * width * -(-n // 64)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``values`` at ``width`` bits each, as rows of bytes: the row is
    cut into 64 lanes, and equal places of the lanes share ``width`` words."""
    n, columns = len(values), -(-values.shape[1] // 64)
    lanes = np.zeros((n, 64 * columns), np.uint64)
    lanes[:, :values.shape[1]] = values
    lanes = lanes.reshape(n, 64, columns)
    words = np.zeros((n, width, columns), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return words.astype("<u8", copy=False).reshape(n, -1).view(np.uint8)


def unpack_bits(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    """Inverse of :func:`pack_bits` for rows of ``n`` values."""
    words = packed.view("<u8").reshape(len(packed), width, -1)
    mask = np.uint64((1 << width) - 1)
    lanes = np.empty((len(packed), 64, words.shape[2]), np.uint32)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, i] = value & mask
    return lanes.reshape(len(packed), -1)[:, :n]


def encode_segment(ids: np.ndarray, block: int = BLOCK_IDS, percentile: int = PERCENTILE) -> bytes:
    """The file image of an array of uint32 ids."""
    n_blocks = -(-len(ids) // block)
    rows = np.zeros((n_blocks, block), np.uint32)
    rows.reshape(-1)[:len(ids)] = ids
    if len(ids) % block:
        rows.reshape(-1)[len(ids):] = ids[-1]
    low = rows.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rows -= low[:, None]
    at = min(block - 1, block * percentile // 100)
    fit = np.partition(rows, at, axis=1)[:, at] if n_blocks else low
    widths = np.ceil(np.log2(fit.astype(np.float64) + 1)).astype(np.int64)
    parts: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths).tolist():
        which = np.flatnonzero(widths == width)
        mine = rows[which]
        over = mine >> np.uint32(width) if width < 32 else np.zeros_like(mine)
        packed = pack_bits(mine & np.uint32((1 << width) - 1), width) if width else None
        r, c = np.nonzero(over)
        cut = np.searchsorted(r, np.arange(len(which) + 1)).tolist()
        position, value = c.astype("<u2"), mine[r, c].astype("<u4")
        for i, b in enumerate(which.tolist()):
            x, y = cut[i], cut[i + 1]
            parts[b] = b"".join((BLOCK.pack(low[b], width, y - x),
                                 packed[i].tobytes() if width else b"",
                                 position[x:y].tobytes(), value[x:y].tobytes()))
    starts = np.zeros(n_blocks + 1, "<u4")
    starts[1:] = np.cumsum([len(p) for p in parts])
    return b"".join((HEADER.pack(MAGIC, block, len(ids), n_blocks, percentile),
                     starts.tobytes(), *parts))


def decode_segment(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last - 1`` of a file image; only the blocks that hold
    them are read."""
    magic, block, n_ids, n_blocks, _ = HEADER.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    last = n_ids if last is None else min(last, n_ids)
    if first >= last:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(image, "<u4", n_blocks + 1, HEADER.size)
    data = HEADER.size + starts.nbytes
    b0, b1 = first // block, -(-last // block)
    heads = [BLOCK.unpack_from(image, data + s) for s in starts[b0:b1].tolist()]
    widths = np.array([h[1] for h in heads])
    out = np.zeros((b1 - b0, block), np.uint32)
    raw = np.frombuffer(image, np.uint8)
    at = data + starts[b0:b1].astype(np.int64) + BLOCK.size
    for width in np.unique(widths).tolist():
        which = np.flatnonzero(widths == width)
        if width:
            size = packed_size(block, width)
            packed = np.stack([raw[a:a + size] for a in at[which].tolist()])
            out[which] = unpack_bits(packed, width, block)
    for i, (_, width, n) in enumerate(heads):
        if n:
            a = int(at[i]) + packed_size(block, width)
            out[i, np.frombuffer(image, "<u2", n, a)] = np.frombuffer(image, "<u4", n, a + 2 * n)
    out += np.array([h[0] for h in heads], np.uint32)[:, None]
    return out.reshape(-1)[first - b0 * block:last - b0 * block]


def write_token_files(docs: DataFrame, tokenizer_path: str, spaces: str, end_id: int) -> DataFrame:
    """Encode every text, append ``end_id`` and write the segments; returns
    the stored data set (columns of :data:`FILES`)."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, enc = TaskContext.get().partitionId(), encoder(tokenizer_path, spaces)
        end, segment, start = np.array([end_id], "<u4"), 0, 0
        names, lengths, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            image = encode_segment(np.concatenate(parts))
            row = ([shard], [segment], [start], [held], [names], [lengths], [image])
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)],
                [c.split()[0] for c in FILES.split(", ")])

        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            for doc, ids in zip(numbers, enc.ids(batch.column("text")), strict=True):
                names.append(doc)
                lengths.append(len(ids) + 1)
                parts += (ids.copy(), end)
                held += len(ids) + 1
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, start = segment + 1, start + held
                    names, lengths, parts, held = [], [], [], 0
        if names:
            yield close()

    # equal ids keep the order of the table
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    return store(ordered.drop("row").mapInArrow(segments, FILES), "tokens", "none")


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document read back from the files: ``doc_id, start,
    n_tokens, ids_crc32`` and its place (``shard, segment``)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row["image"])
                ends = np.cumsum(row["doc_lengths"])
                cuts = [0, *ends.tolist()]
                crc = [zlib.crc32(ids[a:b].tobytes())
                       for a, b in zip(cuts, cuts[1:], strict=False)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()),
                     pa.array(ends - row["doc_lengths"] + row["start"], pa.int64()),
                     pa.array(row["doc_lengths"], pa.int64()), pa.array(crc, pa.int64()),
                     pa.array([row["shard"]] * n, pa.int32()),
                     pa.array([row["segment"]] * n, pa.int32())],
                    ["doc_id", "within", "n_tokens", "ids_crc32", "shard", "segment"])

    found = files.mapInArrow(read, "doc_id long, within long, n_tokens long, ids_crc32 long, "
                                   "shard int, segment int")
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return (found.join(F.broadcast(first), "shard")
            .select("doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens",
                    "ids_crc32", "shard", "segment"))
