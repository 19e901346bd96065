"""Benchmark decontamination by size-partitioned MinHash containment search.

A word is a maximal run of ASCII letters and digits or non-ASCII characters of
the lower-cased text; a shingle is ``SHINGLE_WORDS`` words (a shorter text is
one shingle). An item is found in a document that holds at least ``THRESHOLD``
of the item's distinct shingles.

Items are partitioned by size: class ``c`` holds items of up to ``2**c``
distinct shingles. For each class the shingles of the documents are cut into
blocks of that size, and a window is two neighbouring blocks, so an item of
the class lies whole in some window that is at most four times its size. Each
window's MinHash signature (minima of block minima, shared by all classes) is
compared slot by slot with the items' signatures; one equal slot makes a
candidate. A shared share of 0.19, the least that a match can have, escapes
all ``SLOTS`` slots with probability 2e-6. Candidates are verified by exact
shingle containment over the whole document.

The items are broadcast in blocks of ``BLOCK_BYTES``, each against one pass
over the documents; documents are never shuffled. A worker's index of a block
takes about twenty times its bytes at most (64 minima of 12 bytes an item).

Cases: items without words match nothing; NULL or empty documents hold
nothing; repeated items and repeated documents each give their pairs; an item
repeated in one document counts once; empty tables give an empty result; other
columns are ignored (and kept by :func:`clean_documents`).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text, slices

SHINGLE_WORDS = 5
THRESHOLD = 0.8
SLOTS = 64
#: Text bytes of the items broadcast at once.
BLOCK_BYTES = 16_000_000
#: Items whose shingles a worker keeps after verifying them.
VERIFIED_ITEMS = 2000
CHUNK_CHARS = 2_000_000

#: Every byte that can't be part of a word becomes a space.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORD_BYTES).split()


def shingles_of(words: list[bytes], k: int = SHINGLE_WORDS) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[0]
    x = (x ^ x >> np.uint64(27)) * _MIX[1]
    return x ^ x >> np.uint64(31)


def shingle_hashes(texts: list[str], k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of every text and the text's number, in order.
    Words are hashed by prefix sums of a polynomial modulo 2**64."""
    raw = b" ".join(t.lower().encode().translate(_WORD_BYTES) for t in texts)
    sizes = np.fromiter((len(t.lower().encode()) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    forward = _powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * forward[:-1], out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    word = _mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    owner = np.searchsorted(np.cumsum(sizes), start, side="right")
    first = np.searchsorted(owner, np.arange(len(texts)))
    count = np.diff(np.concatenate([first, [len(owner)]]))
    # shingle i starts at word i; the last k - 1 words of a text start none,
    # except that a shorter text is one shingle
    left = (first + count)[owner] - np.arange(len(owner))  # words left in the text
    begins = (left >= k) | ((count[owner] < k) & (left == count[owner]))
    at = np.flatnonzero(begins)
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate([word, np.zeros(k, np.uint64)])
    for i in range(k):
        part = np.where(left[at] > i, padded[at + i], np.uint64(0))
        total = _mixed(total * np.uint64(_BASE) + part + np.uint64(i))
    return total, owner[at]


def slot_factors(slots: int = SLOTS) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, slots, np.uint64) | np.uint64(1)


class ItemIndex:
    """The items of one broadcast block: signatures by size class, as sorted
    arrays. An item's shingles are made when a candidate is verified."""

    def __init__(self, items: list[str]) -> None:
        self.items = items
        self.factors = slot_factors()
        self.sizes = np.zeros(len(items), np.int64)  # distinct shingles
        low = np.zeros((len(items), SLOTS), np.uint64)
        for a, b in chunks(items, CHUNK_CHARS):
            self.sizes[a:b] = [len(shingles_of(words_of(t))) for t in items[a:b]]
            hashes, owner = shingle_hashes(items[a:b])
            holders, first = np.unique(owner, return_index=True)
            for slot, f in enumerate(self.factors if len(holders) else ()):
                low[a + holders, slot] = np.minimum.reduceat(hashes * f, first)
        held = np.flatnonzero(self.sizes)
        size = np.ceil(np.log2(self.sizes[held])).astype(np.int64)
        #: class -> per slot: which middle bits of a minimum occur, the minima
        #: in order, and their items
        self.classes: dict[int, list] = {}
        for c in np.unique(size).tolist():
            mine = held[size == c]
            bits = max(12, math.ceil(math.log2(16 * len(mine))))
            self.classes[c] = [self._table(low[mine, slot], mine, bits) for slot in range(SLOTS)]
        self.shingles = lru_cache(VERIFIED_ITEMS)(lambda item: shingles_of(words_of(items[item])))

    @staticmethod
    def _table(minima: np.ndarray, items: np.ndarray, bits: int):
        rough = np.zeros(1 << bits, bool)
        rough[_rough(minima, bits)] = True
        order = np.argsort(minima, kind="stable")
        return bits, rough, minima[order], items[order].astype(np.int32)

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
        """``(text number, item number)`` of all candidates."""
        found: set[tuple[int, int]] = set()
        if not len(hashes):
            return found
        for slot, f in enumerate(self.factors):
            values, size = hashes * f, 1
            for c, tables in self.classes.items():  # from small to large
                while size < 1 << c:  # block minima of twice the size
                    if len(values) % 2:
                        values = np.append(values, values[-1])
                    values = np.minimum(values[::2], values[1::2])
                    size *= 2
                window = np.minimum(values, np.append(values[1:], values[-1]))
                bits, rough, minima, items = tables[slot]
                at = np.flatnonzero(rough[_rough(window, bits)])
                lo, hi = (np.searchsorted(minima, window[at], side=s) for s in ("left", "right"))
                for j, x, y in zip(at[lo < hi].tolist(), lo[lo < hi].tolist(), hi[lo < hi].tolist(), strict=True):
                    texts = np.unique(owner[j * size:min(len(owner), (j + 2) * size)]).tolist()
                    found.update((d, item) for item in items[x:y].tolist() for d in texts)
        return found

    def matches(self, texts: list[str], threshold: float = THRESHOLD) -> Iterator[tuple]:
        """``(text number, item number, shared shingles)`` of verified pairs."""
        for a, b in chunks(texts, CHUNK_CHARS):
            by_text = defaultdict(list)
            for d, item in self.candidates(*shingle_hashes(texts[a:b])):
                by_text[d].append(item)
            for d, items in sorted(by_text.items()):
                held = shingles_of(words_of(texts[a + d]))
                for item in sorted(items):
                    shared = len(self.shingles(item) & held)
                    if shared >= threshold * self.sizes[item]:
                        yield a + d, item, shared


def _rough(values: np.ndarray, bits: int) -> np.ndarray:
    """Middle bits of the minima; their top bits are nearly all zero."""
    return values >> np.uint64(24) & np.uint64((1 << bits) - 1)


def item_blocks(items: DataFrame, text_col: str) -> Iterator[list[str]]:
    """The distinct item texts in blocks of about ``BLOCK_BYTES``."""
    texts = (items.select(F.col(text_col).cast("string").alias("item"))
             .filter("item IS NOT NULL").distinct())
    size = texts.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(n):
        block = texts.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield sorted(r["item"] for r in block.collect())


def contaminated(docs: DataFrame, items: DataFrame, item_id: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """All pairs ``doc_id, item_id, n_shingles, n_shared, containment``."""
    spark, rows, found = docs.sparkSession, id_text(docs), None
    schema = "doc_id long, item string, n_shingles long, n_shared long"
    for block in item_blocks(items, item_text):
        index = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            held = ItemIndex(index.value)
            for batch in slices(batches):
                ids = batch.column("doc_id").to_pylist()
                hits = [(ids[d], held.items[i], int(held.sizes[i]), n)
                        for d, i, n in held.matches(batch.column("text").to_pylist())]
                columns = zip(*hits, strict=True) if hits else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        columns, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "item", "n_shingles", "n_shared"])

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("item"))
    return found.join(named, "item").select(
        "doc_id", "item_id", "n_shingles", "n_shared",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, item_text: str = "text",
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item."""
    for block in item_blocks(items, item_text):
        index = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            held = ItemIndex(index.value)
            for batch in slices(batches, text_col):
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                stays = np.ones(len(texts), bool)
                stays[[d for d, _, _ in held.matches(texts)]] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
