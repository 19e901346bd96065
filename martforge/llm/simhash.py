"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles. Two fingerprints link at ``MAX_BITS`` = 4 or fewer differing bits;
a class is what links connect.

Candidates: the 64 bits form three segments of 23, 23 and 18 bits. The binary
Golay code (23, 12, 7) is perfect: every 23-bit word lies within 3 bits of
exactly one code word. A segment gets as keys the code words of itself and of
the words one bit away (one key or six). Two segments that differ in at most
two bits have a word within one bit of both, hence a key in common. At most 4
errors over three segments leave at least two segments with at most two
errors, so any two linked fingerprints share a key pair of some two segments:
three combinations of 2 x 12 key bits. Fingerprints that share one are
compared bit by bit.

Equal fingerprints are one node. Inside a key's bucket only a spanning forest
of the links is emitted, so a dense cluster of copies yields as many links as
it has members.

Cases: NULL or blank text has fingerprint zero, linked like any other; fewer
words than a shingle are one shingle; repeated rows share their class; a NULL
id is no candidate for the class id (a class of NULL ids has NULL); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import frequent_keys, salted_join
from .common import id_text, slices, store, unused
from .components import components, spread_join

SEED = 42
SHINGLE_WORDS = 4
#: Rows of a fingerprint from which on they are dealt over several tasks.
HOT_ROWS = 1000
MAX_BITS = 4
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b110001110101
#: (first bit, width) of the segments and the pairs of segments that form keys.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Buckets up to this size are compared at once with all others of their size.
SMALL_BUCKET = 12
HASHES_AT_ONCE = 1 << 16

_TABLE: list[np.ndarray] = []


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint of a text."""
    tokens = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens, words = [b" ".join(tokens)], 1
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(tokens) - words + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        to = min(n, at + HASHES_AT_ONCE)
        pieces = [joined[a:b] for a, b in zip(
            starts[at:to].tolist(), ends[at + words - 1:to + words - 1].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), "<u8", to - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text_col: str = "text", words: int = SHINGLE_WORDS,
                      name: str = "__fingerprint") -> DataFrame:
    """``docs`` with all its columns and the fingerprint as a (signed) long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = [fingerprint(t or "", words) for t in batch.column(text_col).to_pylist()]
            signed = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, signed],
                                             [*batch.schema.names, name])

    return docs.mapInArrow(add, schema)


def golay_table() -> np.ndarray:
    """Code word number (12 bits) nearest to each 23-bit word."""
    if not _TABLE:
        message = np.arange(4096, dtype=np.uint32)
        code = np.zeros(4096, np.uint32)
        for i in range(12):
            code ^= (message >> np.uint32(i) & np.uint32(1)) * np.uint32(GOLAY << i)
        bit = np.uint32(1) << np.arange(23, dtype=np.uint32)
        errors = [np.zeros(1, np.uint32), bit]
        pairs = np.array([x | y for i, x in enumerate(bit) for y in bit[:i]], np.uint32)
        triples = np.array([x | y | z for i, x in enumerate(bit) for j, y in enumerate(bit[:i])
                            for z in bit[:j]], np.uint32)
        table = np.empty(1 << 23, np.uint16)
        for error in np.concatenate([*errors, pairs, triples]):
            table[code ^ error] = message
        _TABLE.append(table)
    return _TABLE[0]


def segment_keys(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each segment value: an ``(n, 6)`` array and which are in use."""
    near = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    keys = np.sort(golay_table()[values.astype(np.uint32)[:, None] ^ near], axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(keys, order, 1), np.take_along_axis(new, order, 1)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row number, key)`` of every key of the uint64 fingerprints."""
    keys = [segment_keys(prints >> np.uint64(at) & np.uint64((1 << width) - 1), width)
            for at, width in SEGMENTS]
    rows, found = [], []
    for number, (i, j) in enumerate(PAIRS):
        (x, x_used), (y, y_used) = keys[i], keys[j]
        both = (np.int64(number) << 24 | x.astype(np.int64)[:, :, None] << 12
                | y.astype(np.int64)[:, None, :])
        used = x_used[:, :, None] & y_used[:, None, :]
        rows.append(np.nonzero(used)[0])
        found.append(both[used])
    return np.concatenate(rows), np.concatenate(found)


def bucket_links(prints: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of one bucket's links, breadth first: members leave
    the unvisited set as they are reached, so dense clusters shrink it fast."""
    waiting, out, queue = prints, [], []
    while len(waiting):
        if not queue:
            queue, waiting = [waiting[0]], waiting[1:]
        at = queue.pop()
        near = np.bitwise_count(waiting ^ at) <= max_bits
        if near.any():
            found, waiting = waiting[near], waiting[~near]
            out.append((np.full(len(found), at), found))
            queue.extend(found)
    return out


def _links_of(keys: np.ndarray, prints: np.ndarray, max_bits: int):
    """Links within the complete buckets of sorted ``keys``."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([first, [len(keys)]]))
    out = []
    for at, n in zip(first[size > SMALL_BUCKET].tolist(), size[size > SMALL_BUCKET].tolist(),
                     strict=True):
        out += bucket_links(prints[at:at + n], max_bits)
    small = np.repeat(size <= SMALL_BUCKET, size)
    for lag in range(1, SMALL_BUCKET):
        same = np.flatnonzero((keys[lag:] == keys[:-lag]) & small[lag:]) if lag < len(keys) else []
        if not len(same):
            break
        x, y = prints[same], prints[same + lag]
        near = np.bitwise_count(x ^ y) <= max_bits
        out.append((x[near], y[near]))
    return out


def find_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links that connect the distinct fingerprints of ``prints``
    (``fp`` long) exactly as all pairs within ``max_bits`` would."""
    if max_bits > MAX_BITS:
        raise ValueError("the keys guarantee links of at most 4 bits")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(signed), 4096):
                part = np.ascontiguousarray(signed[at:at + 4096])
                rows, keys = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()),
                                                  "fp": pa.array(part[rows], pa.int64())})

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # of the bucket still open

        def found(last: bool):
            keys = np.concatenate([k for k, _ in held])
            values = np.concatenate([v for _, v in held])
            cut = len(keys) if last else int(np.searchsorted(keys, keys[-1]))
            held[:] = [] if last else [(keys[cut:], values[cut:])]
            pairs = _links_of(keys[:cut], values[:cut].view(np.uint64), max_bits) if cut else []
            x = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in pairs)])
            y = np.concatenate([np.zeros(0, np.uint64), *(p[1] for p in pairs)])
            both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
            return pa.RecordBatch.from_pydict(
                {"a": pa.array(both[:, 0].astype(np.uint64).view(np.int64), pa.int64()),
                 "b": pa.array(both[:, 1].astype(np.uint64).view(np.int64), pa.int64())})

        for batch in batches:
            if batch.num_rows:
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                held.append((keys, np.ascontiguousarray(
                    batch.column("fp").to_numpy(zero_copy_only=False))))
                if len(held) == 1 or keys[-1] != held[0][0][0]:
                    yield found(False)
        if held:
            yield found(True)

    keyed = prints.select("fp").mapInArrow(emit, "key long, fp long")
    return (keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(link, "a long, b long"))


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id`` per distinct fingerprint of ``prints``
    (``fp``, ``doc_id``): its class and the smallest ``doc_id`` in it."""
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = components(find_links(nodes, max_bits))
    # only linked fingerprints need their class's smallest id; its members are dealt over tasks
    linked = store(roots.withColumnRenamed("node", "fp").join(nodes, "fp"), "linked")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("smallest"))
    found = spread_join(linked.select("fp", "root"), smallest, "root", "fp")
    return nodes.join(found, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("smallest")).alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` per row."""
    rows = with_fingerprints(id_text(docs), words=words).select(
        "doc_id", F.col("__fingerprint").alias("fp"))
    prints = store(rows, "document-fingerprints")
    hot = frequent_keys(prints, ["fp"], min_rows=HOT_ROWS)["fp"]  # texts in very many copies
    return (salted_join(prints, classes(prints, max_bits), "fp", "inner", hot)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def one_per_class(docs: DataFrame, words: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each class the row with
    the smallest id; of rows that repeat that id, one."""
    mine, fp, root, component = unused(docs.columns, "fingerprint", "fp", "root", "component_id")
    printed = store(with_fingerprints(docs, words=words, name=mine), "fingerprinted")
    prints = printed.select("doc_id", F.col(mine).alias("fp"))
    found = classes(prints, max_bits).toDF(fp, root, component)
    kept = (printed.join(found, F.col(mine) == F.col(fp))
            .filter(F.col("doc_id").cast("long").eqNullSafe(F.col(component))))
    return kept.dropDuplicates([root]).select(*docs.columns)
