"""Exact removal of repeated passages by distributed suffix sorting.

A byte is removed if a ``WINDOW``-byte string that covers it also starts in a
document with a smaller id. All windows of all documents are the suffixes to
sort, compared to a depth of ``WINDOW``.

*Bucketing.* A window's anchor is its ``GRAM``-byte string with the smallest
hash (leftmost of equals): a function of its bytes, so equal windows have equal
anchors at equal places. Neighbouring windows mostly share theirs; each such
run of windows is one string of about ``WINDOW + 20`` bytes, and it is these
strings that go to the bins, by anchor hash. Strings that repeat within a task
are resolved there (all but the smallest id's are removed whole) and sent once,
with all the places where that document has them. Repeats are brought together by
a hash and then compared byte by byte; a hash alone decides nothing.

*Deep-shallow sorting* of a bin. Shallow: the suffixes are split by anchor and
its place, then by multikey quicksort on 8-byte words to ``SHALLOW`` bytes:
groups above ``DIRECT`` are parted in three around a pivot word, smaller ones are
sorted at once; whatever stands alone after a word is done. Deep: the groups left share a long
prefix; each is ordered by a blind trie, which branches on distinguishing bytes
only and compares a suffix with a single leaf. Suffixes at one leaf are equal;
those of larger ids than the leaf's smallest are marked.

*Memory.* The number of bins comes from the bytes of all texts, for about
``BIN_TARGET`` bytes of strings in each. Every chunk of text sends a blob to every
bin, so bins are as large as a task can hold: small ones would make blobs whose
number grows with the square of the input. A task parts the strings of its bin once
more, by anchor, and sorts about ``PART_BYTES`` at once. A part above ``BIN_BYTES``
(an anchor within a very common passage) is passed on: its windows are dealt again
one by one, by all their bytes, to as many bins as they need. The spans found, one
for each repeated string, travel packed by groups of rows; a task merges those of a
group, so that Spark joins one row of spans to a document.

Cases: NULL text is empty; a row with a NULL id keeps all its bytes and removes
none; rows with equal ids never remove each other's bytes; texts shorter than a
window are kept; an empty table gives an empty result; other columns are
ignored. ``docs`` must be a table read from files, so that its rows have the
same numbers in both passes over it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, id_text, store

WINDOW = 50
GRAM = 8
SHALLOW = 24
#: Bytes of strings aimed at in a bin, sorted at once, and sorted at once at most.
BIN_TARGET = 32_000_000
PART_BYTES = 2_000_000
BIN_BYTES = 32_000_000
#: Parts that a bin is dealt into, by anchor, before neighbours are sorted together.
PARTS = 64
#: Bytes of strings per byte of text, about; what a place of a string counts for.
STRING_BYTES, PLACE_BYTES = 4, 16
#: Suffixes of a group that are sorted directly.
DIRECT = 4096
#: Bytes of text whose strings are made distinct at once, and bytes whose
#: anchors are found at once; longer documents are cut into pieces that overlap
#: by a window.
CHUNK_BYTES = 16_000_000
SLICE_BYTES = 500_000
POSITION_BITS = 25
#: Spans that a task packs at once; spans of a group that are merged at once.
#: Bytes of text of a group.
SPANS, MERGED = 500_000, 2_000_000
GROUP_BYTES = 32_000_000
#: Bytes compared at once.
COMPARED = 1_000_000
#: Rows (texts, blobs) that a task holds at a time.
BATCH_ROWS = 100
ROWS = "kind int, bin long, row long, first long, last long, payload binary"
BLOB, SPAN, OVERFLOW = 0, 1, 2
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIER = np.uint64(0xBF58476D1CE4E5B9)


@cache
def _first_powers(base: int) -> np.ndarray:
    out = np.full(1 << 14, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    first = _first_powers(base)
    leaps = np.full(max(1, -(-n // len(first))), pow(base, len(first), 1 << 64), np.uint64)
    leaps[0] = 1
    return (np.multiply.accumulate(leaps)[:, None] * first).ravel()[:n]


class SliceHash:
    """Hashes of any slices of a byte array, by polynomial prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)),
                  out=self.sums[1:])
        self.inverse = powers(_INVERSE, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return (x ^ x >> np.uint64(31)) * _MULTIPLIER


def words_at(data: np.ndarray, at: np.ndarray, size: int = 8) -> np.ndarray:
    """The big-endian words of ``size`` bytes at each position."""
    out = np.zeros(len(at), np.uint64)
    for i in range(size):
        out = out << np.uint64(8) | data[at + i]
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``start .. start + size - 1``."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)


def anchored_runs(data: np.ndarray, ends: np.ndarray, window: int = WINDOW):
    """Runs of windows with one anchor in concatenated pieces of text:
    ``(piece, first window, number of windows, anchor, anchor hash)``."""
    none = np.zeros(0, np.int64)
    n = len(data) - GRAM + 1
    if len(data) < window:
        return none, none, none, none, none.astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for i in range(GRAM):
        word |= data[i:i + n].astype(np.uint64) << np.uint64(8 * i)
    word *= np.uint64(_BASE)
    word ^= word >> np.uint64(29)
    word *= _MULTIPLIER
    low = np.uint64(POSITION_BITS)
    best = word >> low << low | np.arange(n, dtype=np.uint64)
    wide, reach = window - GRAM + 1, 1
    while 2 * reach <= wide:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < wide:
        best = np.minimum(best[:reach - wide], best[wide - reach:])
    anchor = (best & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[begins[begins < len(new)]] = True
    first = np.flatnonzero(new)
    piece = np.searchsorted(ends, first, side="right")
    last = np.minimum(np.append(first[1:], len(anchor)), ends[piece] - window + 1)
    ok = last > first  # windows don't cross pieces
    first, last, piece = first[ok], last[ok], piece[ok]
    return piece, first, last - first, anchor[first], best[first] >> low


def thin(x: np.ndarray) -> bytes:
    low = int(x.min()) if len(x) else 0
    wide = x.astype(np.int64).view(np.uint64) - np.uint64(low & (1 << 64) - 1)
    return np.int64(low).tobytes() + np.ascontiguousarray(
        wide.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def thick(raw: bytes, at: int, sizes: tuple[int, ...]) -> tuple[list[np.ndarray], int]:
    """Columns of ``sizes`` that :func:`thin` has written from byte ``at`` on, and their end."""
    columns = []
    for m in sizes:
        low = np.frombuffer(raw, np.uint8, 8, at).view(np.int64)[0]
        wide = np.frombuffer(raw, np.uint8, 8 * m, at + 8).reshape(8, m).T
        columns.append(np.ascontiguousarray(wide).view("<u8").ravel().view(np.int64) + low)
        at += 8 + 8 * m
    return columns, at


def pack(strings: np.ndarray, size: np.ndarray, anchor: np.ndarray, doc: np.ndarray,
         count: np.ndarray, row: np.ndarray, pos: np.ndarray) -> bytes:
    """A blob of strings and of their places (``count`` of ``row, pos`` for
    each), compressed by columns: lengths and anchor places in a byte each,
    numbers as differences from the smallest, transposed by byte."""
    head = np.array([len(size), len(row)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(b"".join(
        (head, size.astype(np.uint8).tobytes(), anchor.astype(np.uint8).tobytes(),
         thin(doc), thin(count), thin(row), thin(pos), strings.tobytes())))


def unpack(blob: bytes):
    """``data, size, anchor, doc, count`` of the strings, ``row, pos`` of the places."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, places = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    size = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    anchor = np.frombuffer(raw, np.uint8, n, at + n).astype(np.int64)
    columns, at = thick(raw, at + 2 * n, (n, n, places, places))
    return np.frombuffer(raw, np.uint8, offset=at), size, anchor, *columns


class BlindTrie:
    """Strings of equal length at the leaves; inner nodes hold the position of
    a distinguishing byte and the children by that byte."""

    def __init__(self, first: bytes) -> None:
        self.root: list = [first, [0]]

    def insert(self, text: bytes, member: int) -> None:
        node = self.root
        while len(node) == 3:  # blind descent: skipped bytes aren't looked at
            node = node[2].get(text[node[1]]) or next(iter(node[2].values()))
        leaf = node[0]
        if leaf == text:
            node[1].append(member)
            return
        differ = int.from_bytes(leaf) ^ int.from_bytes(text)
        at = len(text) - (differ.bit_length() + 7) // 8
        node = self.root  # the branch belongs above the first node beyond it
        while len(node) == 3 and node[1] < at:
            node = node[2][text[node[1]]]
        if len(node) == 3 and node[1] == at:
            node[2][text[at]] = [text, [member]]
        else:
            old = node[:]
            node[:] = [None, at, {leaf[at]: old, text[at]: [text, [member]]}]

    def leaves(self) -> Iterator[list[int]]:
        """Members of each leaf, in lexicographic order of the strings."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if len(node) == 3:
                waiting += [node[2][b] for b in sorted(node[2], reverse=True)]
            else:
                yield node[1]


def _parted(group: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Finer groups in the order of ``(group, word)``: those above ``DIRECT``
    members are parted in three around a pivot word, again and again; the middle
    part, equal to the pivot, is done."""
    sizes = np.bincount(group)
    large = np.flatnonzero(sizes > DIRECT)
    if not len(large):
        return group
    place, parts = np.zeros(len(group), np.int64), 1
    rng = np.random.default_rng(len(group))
    for g in large.tolist():
        waiting, number = [(np.flatnonzero(group == g), False)], 0
        while waiting:
            members, equal = waiting.pop()
            if equal or len(members) <= DIRECT:
                place[members] = number
                number += 1
                continue
            w = word[members]
            pivot = np.sort(w[rng.integers(0, len(w), 3)])[1]
            waiting += [(members[w > pivot], False), (members[w == pivot], True), (members[w < pivot], False)]
        parts = max(parts, number)
    return group * parts + place


def _split(group: np.ndarray, word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One word of multikey quicksort: members ordered by (group, word), their
    new groups; groups that hold a single document's suffixes are dropped."""
    parted = _parted(group, word)
    order = np.lexsort((word, parted))
    g, w, d = parted[order], word[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    several = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first) if len(first) else first
    number = np.cumsum(new) - 1
    keep = several[number] if len(first) else np.zeros(0, bool)
    return order[keep], number[keep]


def mark_windows(data: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray,
                 doc: np.ndarray, hashed: SliceHash, window: int = WINDOW) -> np.ndarray:
    """``(string, window)`` pairs whose bytes also occur in a string of a
    smaller document; the strings are distinct, ``hashed`` hashes ``data``."""
    at, right = start + anchor, size - anchor - GRAM
    half = (window - GRAM) // 2

    def shared(lo: np.ndarray, hi: np.ndarray, has: np.ndarray) -> np.ndarray:
        """Strings whose slice occurs in strings of several documents."""
        out = np.zeros(len(start), bool)
        mine = np.flatnonzero(has)
        out[mine[_split(np.zeros(len(mine), np.int64), hashed(lo[mine], hi[mine]),
                        doc[mine])[0]]] = True
        return out

    # of the bytes beside the anchor, a window holds at least half on one side
    left = shared(at - half, at + GRAM, anchor >= half)
    after = shared(at, at + GRAM + half, right >= half)
    n_windows = size - window + 1
    string = np.repeat(np.arange(len(start)), n_windows)
    turn = ragged(np.zeros(len(start), np.int64), n_windows)
    place = anchor[string] - turn  # of the anchor within the window
    live = np.where(place >= half, left[string], after[string])
    string, turn, place = string[live], turn[live], place[live]
    if not len(string):
        return np.zeros((0, 2), np.int64)
    suffix, owner = start[string] + turn, doc[string]
    kept, group = _split(place, words_at(data, at[string]), owner)
    for depth in range(0, SHALLOW, 8):
        order, group = _split(group, words_at(data, suffix[kept] + depth), owner[kept])
        kept = kept[order]
    marked: list[int] = []
    raw, owner, where = data.tobytes(), owner[kept], suffix[kept] + SHALLOW
    deep, cut = window - SHALLOW, np.flatnonzero(np.diff(group)) + 1
    begin, end = np.concatenate([[0], cut]), np.append(cut, len(kept))
    # two leaves need no trie: equal ones mark that of the larger id
    two = begin[end - begin == 2]
    step = COMPARED // deep
    for i in range(0, len(two), step):
        a = two[i:i + step]
        those, these = (data[where[x][:, None] + np.arange(deep)] for x in (a, a + 1))
        a = a[(those == these).all(1)]
        marked += (a + (owner[a + 1] > owner[a])).tolist()
    ids, where = owner.tolist(), where.tolist()
    more = end - begin > 2
    for a, b in zip(begin[more].tolist(), end[more].tolist(), strict=True):
        trie = BlindTrie(raw[where[a]:where[a] + deep])
        for i in range(a + 1, b):
            trie.insert(raw[where[i]:where[i] + deep], i - a)
        for members in trie.leaves():
            if len(members) > 1:
                least = min(ids[a + i] for i in members)
                marked += [a + i for i in members if ids[a + i] > least]
    chosen = kept[np.array(marked, np.int64)]
    return np.stack([string[chosen], turn[chosen]], 1)


def _merged(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans in order, overlapping and adjacent ones of a row merged."""
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    if len(row):
        # rows apart from each other on one line, so that one running maximum does
        group = np.cumsum(np.concatenate([[0], row[1:] != row[:-1]]))
        width = int(last.max()) + 2
        end = np.maximum.accumulate(last + group * width)
        new = np.ones(len(row), bool)
        new[1:] = (first + group * width)[1:] > end[:-1]
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(row)) - 1
        row, first, last = row[at], first[at], end[stop] - group[stop] * width
    return row, first, last


def _spans(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    """Span rows, overlapping and adjacent ones of a row merged."""
    row, first, last = _merged(row, first, last)
    return _batch(SPAN, -1, row, first, last, pa.nulls(len(row), pa.binary()))


def pack_spans(batches: Iterator[pa.RecordBatch], n_groups: int) -> Iterator[pa.RecordBatch]:
    """The rows, spans packed: a blob for each group of rows, whose number is in ``row``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows or batch.column("kind")[0].as_py() != SPAN:
            yield batch
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= SPANS:
            yield _packed(held, n_groups)
            held, size = [], 0
    if held:
        yield _packed(held, n_groups)


def _packed(batches: list[pa.RecordBatch], n_groups: int) -> pa.RecordBatch:
    row, first, last = _merged(*(np.concatenate([np.asarray(b.column(c)) for b in batches])
                                 for c in ("row", "first", "last")))
    mixed = (row.view(np.uint64) * np.uint64(_BASE) ^ row.view(np.uint64) >> np.uint64(31)) * _MULTIPLIER
    group = (mixed >> np.uint64(33)).astype(np.int64) % n_groups
    order = np.argsort(group, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
    packer = zstandard.ZstdCompressor(level=3)
    payload = [packer.compress(b"".join(thin(x[mine]) for x in (row, first, last)))
               for mine in np.split(order, at[1:])]
    return _batch(SPAN, -1, group[order[at]], 0, 0, payload)


def merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with spans, in order and merged, from the packed
    spans, which come ordered by group."""
    unpacker = zstandard.ZstdDecompressor()
    current, held, size, bound = None, [], 0, MERGED
    for batch in batches:
        for group, blob in zip(*(batch.column(c).to_pylist() for c in ("row", "payload")), strict=True):
            if group != current:
                if held:
                    yield _by_row(held)
                current, held, size, bound = group, [], 0, MERGED
            raw = unpacker.decompress(blob)
            held.append(thick(raw, 0, (len(raw) // 24 - 1,) * 3)[0])
            size += len(held[-1][0])
            if size > bound:
                held = [_merged(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                bound = 2 * size + MERGED
    if held:
        yield _by_row(held)


def _by_row(spans: list) -> pa.RecordBatch:
    row, first, last = _merged(*map(np.concatenate, zip(*spans, strict=True)))
    at = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
    raw = np.stack([first, last], 1).tobytes()
    ends = [*(16 * at).tolist(), len(raw)]
    return pa.RecordBatch.from_arrays(
        [pa.array(row[at], pa.int64()),
         pa.array([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["row", "spans"])


def _batch(kind: int, bins, row, first, last, payload) -> pa.RecordBatch:
    n = len(payload)
    full = lambda x, t: pa.array(np.full(n, x) if np.isscalar(x) else x, t)
    return pa.RecordBatch.from_arrays(
        [full(kind, pa.int32()), full(bins, pa.int64()), full(row, pa.int64()),
         full(first, pa.int64()), full(last, pa.int64()), pa.array(payload, pa.binary())],
        [c.split()[0] for c in ROWS.split(", ")])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of ``(doc, row, base, bytes)`` of about ``CHUNK_BYTES``."""
    held, size = [], 0
    for batch in batches:
        for doc, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")),
                                  strict=True):
            raw = text.encode()
            for base in range(0, max(1, len(raw) - WINDOW + 1), SLICE_BYTES):
                part = raw[base:base + SLICE_BYTES + WINDOW - 1]
                held.append((doc, row, base, part))
                size += len(part)
                if size >= CHUNK_BYTES:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _distinct(key: np.ndarray, doc: np.ndarray, data: np.ndarray, start: np.ndarray,
              size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by string, the group of each, and the smallest id of each group.
    Members of a group have equal bytes: neighbours in the order of the hash
    ``key`` are compared, a slice at a time. (Strings that a collision of hashes
    mixes may end in several groups, which only leaves more to the sorting.)"""
    order = np.lexsort((doc, key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (size[order[1:]] != size[order[:-1]])
    check = np.flatnonzero(~new)
    step = max(1, COMPARED // int(size.max(initial=1)))
    for at in range(0, len(check), step):
        mine = check[at:at + step]
        these, those = order[mine], order[mine - 1]
        length = size[these]
        equal = data[ragged(start[these], length)] == data[ragged(start[those], length)]
        new[mine] = ~np.logical_and.reduceat(equal, np.cumsum(length) - length)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(k) else doc
    return order, group, least


def hashed_runs(data: np.ndarray, ends: np.ndarray):
    """:func:`anchored_runs` of all pieces, a slice at a time, with a hash of
    each run's bytes: ``(piece, first, windows, anchor, anchor hash, hash)``."""
    begins = np.concatenate([[0], ends[:-1]])
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), len(ends)]
    found = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            at = begins[a]
            part = data[at:ends[b - 1]]
            piece, first, n, anchor, hashed = anchored_runs(part, ends[a:b] - at)
            whole = SliceHash(part)(first, first + n + WINDOW - 1)
            found.append((piece + a, first + at, n, anchor + at, hashed, whole))
    return (np.concatenate(x) for x in zip(*found, strict=True))


def deal_strings(batches: Iterator[pa.RecordBatch], n_bins: int) -> Iterator[pa.RecordBatch]:
    """Blobs of anchored strings by bin, and spans resolved within the task."""
    for pieces in _pieces(batches):
        data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        ends = np.cumsum([len(p[3]) for p in pieces])
        piece, first, n, anchor, hashed, whole = hashed_runs(data, ends)
        if not len(piece):
            continue
        docs, rows, bases = (np.array([p[i] for p in pieces], np.int64) for i in range(3))
        begins = ends - np.array([len(p[3]) for p in pieces])
        size, doc, row = n + WINDOW - 1, docs[piece], rows[piece]
        pos = first - begins[piece] + bases[piece]
        del pieces
        order, group, least = _distinct(whole, doc, data, first, size)
        again = doc[order] > least[group]
        seen = order[again]
        yield _spans(row[seen], pos[seen], pos[seen] + size[seen])
        left, group = order[~again], group[~again]
        del order, again, seen
        string, start, count = _leads(left, group)
        # anchors are minima, so their hashes crowd near zero: spread them again
        spread = hashed[string] * _MULTIPLIER ^ hashed[string] * np.uint64(_BASE) >> np.uint64(32)
        bins = ((spread >> np.uint64(32)) * np.uint64(n_bins) >> np.uint64(32)).astype(np.int64)
        yield from _blobs(bins, data, first[string], size[string], (anchor - first)[string], doc[string],
                          start, count, row[left], pos[left])


def _leads(members: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first member of each group of sorted ``group``, where the group
    begins, and its size."""
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
    return members[start], start, np.diff(np.append(start, len(group)))


def _blobs(bins, data, start, size, anchor, doc, place, count, row, pos) -> Iterator[pa.RecordBatch]:
    """One blob row per bin of the strings; ``first`` holds its bytes. String
    ``i`` stands at the places ``place[i] ... + count[i]`` of ``row, pos``."""
    by = np.argsort(bins, kind="stable")
    bins = bins[by]
    at = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]])) if len(bins) else []
    payload, weight = [], []
    for a, b in zip(at, [*at[1:], len(bins)], strict=True):
        mine = _taken(by[a:b], data, start, size, anchor, doc, place, count, row, pos)
        payload.append(pack(*mine))
        weight.append(len(mine[0]) + PLACE_BYTES * len(mine[-1]))
    yield _batch(BLOB, bins[at] if len(bins) else 0, 0, np.array(weight, np.int64), 0, payload)


def _taken(mine, data, start, size, anchor, doc, place, count, row, pos) -> tuple[np.ndarray, ...]:
    """The strings ``mine`` with their places, as :func:`pack` takes them."""
    places = ragged(place[mine], count[mine])
    return (data[ragged(start[mine], size[mine])], size[mine], anchor[mine], doc[mine],
            count[mine], row[places], pos[places])


class Bin:
    """The strings of several blobs, in ``PARTS`` parts by their anchors."""

    def __init__(self, blobs: list[bytes]) -> None:
        data, size, anchor, doc, count, row, pos = (np.concatenate(x) for x in zip(
            *map(unpack, blobs), strict=True))
        start, place = np.cumsum(size) - size, np.cumsum(count) - count
        self.columns = data, start, size, anchor, doc, place, count, row, pos
        word = words_at(data, start + anchor) * np.uint64(_BASE)
        word = (word ^ word >> np.uint64(29)) * _MULTIPLIER
        self.part = (word >> np.uint64(32)).astype(np.int64) * PARTS >> 32
        self.bytes = size + PLACE_BYTES * count
        self.weight = np.zeros(PARTS, np.int64)
        np.add.at(self.weight, self.part, self.bytes)

    def taken(self, mine: np.ndarray) -> tuple[np.ndarray, ...]:
        return _taken(mine, *self.columns)

    def passed_on(self, number: int, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Blobs of some ``parts``, each of about ``PART_BYTES``."""
        mine = np.flatnonzero(parts[self.part])
        cuts = np.flatnonzero(np.diff(np.cumsum(self.bytes[mine]) // PART_BYTES)) + 1
        for some in np.split(mine, cuts):
            if len(some):
                yield _batch(OVERFLOW, number, 0, int(self.bytes[some].sum()), 0, [pack(*self.taken(some))])

    def pieces(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """The strings of ``parts``, neighbouring parts together up to about ``PART_BYTES``."""
        weight = np.where(parts, self.weight, 0)
        piece = np.where(parts, (np.cumsum(weight) - weight) // PART_BYTES, -1)[self.part]
        order = np.argsort(piece, kind="stable")
        order = order[np.searchsorted(piece[order], 0):]
        for mine in np.split(order, np.flatnonzero(np.diff(piece[order])) + 1):
            if len(mine):
                yield self.taken(mine)


def _lightened(number: int, blobs: list[bytes], passed: np.ndarray, limit: int):
    """Pass the heaviest parts of a bin on, until the others fit into ``limit``;
    they are added to ``passed``. Returns a blob of the others, and its bytes."""
    held = Bin(blobs)
    left = np.where(passed, 0, held.weight)
    for part in np.argsort(-left).tolist():
        if left.sum() <= limit:
            break
        passed[part], left[part] = True, 0
    yield from held.passed_on(number, passed)
    return [pack(*held.taken(np.flatnonzero(~passed[held.part])))], int(left.sum())


def _sorted_bin(blobs: list[bytes], number: int = 0, passed: np.ndarray | None = None,
                limit: int = 1 << 62) -> Iterator[pa.RecordBatch]:
    """Spans found in one bin; blobs of its parts that were ``passed`` on before
    and of those above ``limit`` bytes."""
    held = Bin(blobs)
    over = held.weight > limit if passed is None else (held.weight > limit) | passed
    yield from held.passed_on(number, over)
    for piece in held.pieces(~over):
        yield _sorted_part(*piece)


def _sorted_part(data, size, anchor, doc, count, row, pos) -> pa.RecordBatch:
    """Spans found in strings that are sorted together."""
    start, place = np.cumsum(size) - size, np.cumsum(count) - count
    hashed = SliceHash(data)
    order, group, least = _distinct(hashed(start, start + size), doc, data, start, size)
    whole = doc[order] > least[group]
    lead = order[np.concatenate([[True], group[1:] != group[:-1]])]  # one per string
    marks = mark_windows(data, start[lead], size[lead], anchor[lead], doc[lead], hashed)
    # windows of a string apply wherever the string stands in its first document
    mine = order[~whole]
    by = group[~whole]
    lo, hi = np.searchsorted(by, marks[:, 0]), np.searchsorted(by, marks[:, 0], side="right")
    string = np.concatenate([order[whole], mine[ragged(lo, hi - lo)]])
    turn = np.concatenate([np.zeros(int(whole.sum()), np.int64), np.repeat(marks[:, 1], hi - lo)])
    length = np.concatenate([size[order[whole]], np.full(len(turn) - int(whole.sum()), WINDOW)])
    return _placed(string, turn, length, place, count, row, pos)


def _placed(string, turn, length, place, count, row, pos) -> pa.RecordBatch:
    """Spans of ``length`` from ``turn`` on, wherever each string stands."""
    at = ragged(place[string], count[string])
    first = pos[at] + np.repeat(turn, count[string])
    return _spans(row[at], first, first + np.repeat(length, count[string]))


def sort_bins(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sort each bin of the rows, which come ordered by bin; pass spans and
    blobs of the parts above ``limit`` bytes through."""
    held: list[bytes] = []
    current, size, passed = None, 0, np.zeros(PARTS, bool)
    for batch in batches:
        kinds = np.asarray(batch.column("kind"))
        if (kinds == SPAN).any():
            yield batch.filter(pa.array(kinds == SPAN))
        for i in np.flatnonzero(kinds != SPAN).tolist():
            number = batch.column("bin")[i].as_py()
            if number != current:
                if held:
                    yield from _sorted_bin(held, current, passed, limit)
                current, held, size, passed = number, [], 0, np.zeros(PARTS, bool)
            size += batch.column("first")[i].as_py()
            held.append(batch.column("payload")[i].as_py())
            if size > 2 * limit:
                held, size = yield from _lightened(current, held, passed, limit)
    if held:
        yield from _sorted_bin(held, current, passed, limit)


def deal_windows(batches: Iterator[pa.RecordBatch], n_bins: int) -> Iterator[pa.RecordBatch]:
    """The windows of passed-on blobs one by one, by a hash of all their bytes."""
    for batch in batches:
        for blob in batch.column("payload").to_pylist():
            data, size, _, doc, count, row, pos = unpack(blob)
            start, place, n = np.cumsum(size) - size, np.cumsum(count) - count, size - WINDOW + 1
            string = np.repeat(np.arange(len(size)), n)
            turn = ragged(np.zeros(len(size), np.int64), n)
            first = start[string] + turn
            length = np.full(len(first), WINDOW)
            hashed = SliceHash(data)(first, first + WINDOW)
            order, group, least = _distinct(hashed, doc[string], data, first, length)
            again = doc[string][order] > least[group]
            seen, left, group = order[again], order[~again], group[~again]
            yield _placed(string[seen], turn[seen], length[seen], place, count, row, pos)
            window, at, _ = _leads(left, group)
            # a window stands wherever the strings that hold it stand
            times = count[string[left]]
            places = ragged(place[string[left]], times)
            total = np.concatenate([[0], np.cumsum(times)])
            begins = total[at]
            bins = (hashed[window] % np.uint64(n_bins)).astype(np.int64)
            yield from _blobs(bins, data, first[window], length[window], np.zeros(len(window), np.int64),
                              doc[string[window]], begins, np.diff(np.append(begins, total[-1])),
                              row[places], pos[places] + np.repeat(turn[left], times))


def repeated_spans(rows: DataFrame, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """``row, spans``: byte ranges of ``rows`` (``row``, ``doc_id``, ``text``) to
    remove, in order and apart, as pairs of 8-byte numbers; rows without any are left out."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # as many bins, and groups, for every task
    n_bins, n_groups = (partitions * max(1, math.ceil(x / partitions)) for x in (
        size * STRING_BYTES / BIN_TARGET, size / GROUP_BYTES))

    def solve(dealt: DataFrame, name: str, limit: int = bin_bytes) -> DataFrame:
        # spans are spread by row, blobs meet by bin
        task = F.when(F.col("kind") == SPAN, F.hash("row")).otherwise(F.col("bin"))
        with batch_rows(spark, BATCH_ROWS):
            return store(dealt.repartitionById(partitions, F.pmod(task, F.lit(partitions)).cast("int"))
                         .sortWithinPartitions("bin")
                         .mapInArrow(lambda b: pack_spans(sort_bins(b, limit), n_groups), ROWS), name)

    found = solve(rows.filter("doc_id IS NOT NULL")
                  .mapInArrow(lambda b: deal_strings(b, n_bins), ROWS), "spans")
    spans = found.filter(F.col("kind") == SPAN)
    over = found.filter(F.col("kind") == OVERFLOW)
    # each blob's strings hold at most 50 bytes per byte once cut into windows
    weight = over.agg(F.sum(F.octet_length("payload"))).first()[0]
    if weight:
        more = max(1, math.ceil(weight * 4 * WINDOW / bin_bytes))
        again = solve(over.mapInArrow(lambda b: deal_windows(b, more), ROWS), "more-spans")
        # equal windows gather one copy per blob here, a size set by the number of tasks
        left = again.filter(F.col("kind") == OVERFLOW)
        if not left.isEmpty():
            again = solve(left.withColumn("kind", F.lit(BLOB)), "last-spans", 1 << 62).unionByName(again)
        spans = spans.unionByName(again.filter(F.col("kind") == SPAN))
    with batch_rows(spark, BATCH_ROWS):
        return store(spans.repartitionById(partitions, (F.col("row") % partitions).cast("int"))
                     .sortWithinPartitions("row").mapInArrow(merge_spans, "row long, spans binary"), "row-spans")


def remove_repeats(docs: DataFrame, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) for every row."""
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    spans = repeated_spans(rows, bin_bytes)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)  # texts cross the network compressed
        for batch in batches:
            texts = [packer.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(texts, pa.binary())],
                ["doc_id", "row", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, packed, spans in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "text", "spans")), strict=True):
                raw, kept, done, removed = unpacker.decompress(packed), [], 0, 0
                spans = np.frombuffer(spans or b"", np.int64).reshape(-1, 2).tolist()
                if spans and spans[-1][1] > len(raw):
                    raise ValueError("rows were numbered differently in the second pass")
                for first, last in spans:
                    kept.append(raw[done:first])
                    done = last
                    removed += last - first
                out.append((doc, len(raw), removed, len(spans), b"".join((*kept, raw[done:]))))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    packed = rows.mapInArrow(shrink, "doc_id long, row long, text binary")
    return (packed.join(spans, "row", "left").select("doc_id", "text", "spans")
            .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
