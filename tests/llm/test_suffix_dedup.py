"""Repeated passages against brute force over all windows."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.llm import suffix_dedup as sd


def brute(docs, w=50):
    """(doc_id, text) rows -> (id, bytes, removed, spans, sha of the rest)"""
    least = {}
    for d, t in docs:
        raw = (t or "").encode()
        for i in range(len(raw) - w + 1):
            if d is not None:
                s = raw[i:i + w]
                least[s] = min(d, least.get(s, d))
    out = Counter()
    for d, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - w + 1):
            if d is not None and least[raw[i:i + w]] < d:
                gone[i:i + w] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out[d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("etaoinshr é", k=rng.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(rng.randint(5, 60)) for _ in range(12)] + ["ab" * 40, "z" * 120, "x" * 49, "y" * 50]
    docs = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 2)
            parts += [text(rng.randint(0, 40)), p[cut:] if rng.random() < 0.5 else p]
        docs.append((rng.randint(-50, 10_000), " ".join(parts)))
    docs += [(20_000 + i, docs[i % 7][1]) for i in range(40)]  # copies
    docs += [(d, t) for d, t in docs[:5]]  # repeated rows
    docs += [(docs[9][0], docs[11][1]), (None, docs[3][1]), (None, None), (30_000, None)]
    docs += [(40_000, " ".join(t or "" for _, t in docs)), (40_001, ("q" * 300 + text(9)) * 9)]
    rng.shuffle(docs)
    return docs


def run(spark, rows, tmp_dir, schema="doc_id long, text string", parts=4, **kw):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{tmp_dir}/d")
    docs = spark.read.parquet(f"{tmp_dir}/d")
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                   for r in sd.remove_repeats(docs, **kw).collect())


def test_equals_brute_force(spark, tmp_dir):
    docs = corpus()
    want = brute(docs)
    assert run(spark, docs, tmp_dir) == want
    assert sum(k[2] for k in want) > 10_000


@pytest.mark.parametrize("limit", [1, 3000])
def test_large_bins_are_dealt_again(spark, tmp_dir, limit):
    docs = corpus(3)
    assert run(spark, docs, tmp_dir, bin_bytes=limit) == brute(docs)


def test_documents_longer_than_a_chunk(spark, tmp_dir, monkeypatch):
    docs = corpus(5)
    long = [(1, "".join(t or "" for _, t in docs)), (2, "".join(t or "" for _, t in docs[20:]))]
    batch = sd.id_text(spark.createDataFrame(long, "doc_id long, text string")).toArrow()
    batch = batch.append_column("row", [[0, 1]]).combine_chunks().to_batches()
    monkeypatch.setattr(sd, "CHUNK_BYTES", 700)
    monkeypatch.setattr(sd, "SLICE_BYTES", 300)
    rows = [b for b in sd.deal_strings(iter(batch), 3)]
    windows = Counter()
    for b in rows:
        for r in b.to_pylist():
            if r["payload"]:
                data, size, _, _, count, row, pos = sd.unpack(r["payload"])
                start = np.repeat(np.cumsum(size) - size, count)
                for s, n, x, p in zip(start, np.repeat(size, count), row, pos, strict=True):
                    raw = long[x][1].encode()
                    assert data[s:s + n].tobytes() == raw[p:p + n]
                    windows.update((int(x), int(p) + i) for i in range(n - 49))
            else:  # a span that the chunk has resolved
                windows.update((r["row"], p) for p in range(r["first"], r["last"] - 49))
    for x, (_, t) in enumerate(long):
        for i in range(len(t.encode()) - 49):
            assert windows[x, i] >= 1


def test_large_groups_are_parted_in_three(monkeypatch):
    rng = np.random.default_rng(2)
    group, doc = rng.integers(0, 3, 3000), rng.integers(0, 50, 3000)
    word = rng.choice(rng.integers(0, 1 << 60, 40), 3000).astype(np.uint64)
    want = sd._split(group, word, doc)
    monkeypatch.setattr(sd, "DIRECT", 8)
    parted = sd._parted(group, word)
    order = np.lexsort((word, group))
    assert (np.diff(parted[order]) >= 0).all() and len(np.unique(parted)) > 60
    got = sd._split(group, word, doc)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_equal_hashes_decide_nothing(spark, tmp_dir, monkeypatch):
    class Collides(sd.SliceHash):
        def __call__(self, start, end):
            return np.zeros(len(start), np.uint64)

    monkeypatch.setattr(sd, "SliceHash", Collides)
    docs = [d for d in corpus(7) if d[0] is None or d[0] < 30_000]
    data = np.frombuffer("".join(t or "" for _, t in docs).encode(), np.uint8)
    start = np.arange(0, len(data) - 60, 7)
    size = np.full(len(start), 50)
    order, group, least = sd._distinct(np.zeros(len(start), np.uint64), start % 5, data, start, size)
    texts = [data[start[i]:start[i] + 50].tobytes() for i in order.tolist()]
    assert all((x == y) == (g == h) for x, y, g, h in zip(texts, texts[1:], group, group[1:], strict=False))
    rows = [(1, "a" * 30 + "bc" * 40), (2, "bc" * 40), (3, "unlike " * 20), (4, "unlike " * 20 + "x")]
    assert run(spark, rows, tmp_dir) == brute(rows)


def peak_mb(action):
    tracemalloc.start()
    action()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_of_a_run_of_one_byte(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "row": [0, 1], "text": ["a" * 5_000_000, "a" * 400]})
    dealt, spans = [], []
    assert peak_mb(lambda: dealt.extend(sd.deal_strings(iter([batch]), 7))) < 1200
    blobs = [r["payload"] for b in dealt for r in b.to_pylist() if r["payload"]]
    assert sum(map(len, blobs)) < 20_000_000
    assert peak_mb(lambda: spans.extend(sd._sorted_bin(blobs))) < 1200
    gone = [(r["row"], r["first"], r["last"]) for b in [*dealt, *spans] for r in b.to_pylist() if not r["payload"]]
    assert gone == [(1, 0, 400)]


def test_memory_of_a_bin_at_its_limit():
    rng = np.random.default_rng(1)
    words = rng.integers(97, 123, 4_000_000).astype(np.uint8)
    n = sd.BIN_BYTES // (90 + sd.PLACE_BYTES)
    start = rng.integers(0, len(words) - 90, n)
    data = words[sd.ragged(start, np.full(n, 90))]
    blob = sd.pack(data, np.full(n, 90), np.full(n, 41), rng.integers(0, 1000, n), np.ones(n, np.int64),
                   np.arange(n), start)
    assert peak_mb(lambda: list(sd._sorted_bin([blob]))) < 1200


def test_bins_are_sorted_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    words = rng.integers(97, 123, 600_000).astype(np.uint8)
    n = 60_000
    start, size, doc = rng.integers(0, len(words) - 90, n), rng.integers(58, 90, n), rng.integers(0, 1000, n)
    data, anchor = words[sd.ragged(start, size)], np.full(n, 41)
    sizes, real = [], sd.mark_windows
    monkeypatch.setattr(sd, "mark_windows", lambda data, *a, **kw: sizes.append(len(data)) or real(data, *a, **kw))
    third = np.array_split(np.arange(n), 3)
    at = np.cumsum(size) - size
    blobs = [sd.pack(data[at[i[0]]:at[i[-1]] + size[i[-1]]], size[i], anchor[i], doc[i], np.ones(len(i), np.int64),
                     i, i % 7) for i in third]
    list(sd._sorted_bin(blobs))
    assert len(sizes) > 1 and max(sizes) < 2 * sd.PART_BYTES


def test_spans_travel_packed(spark, tmp_dir, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefgh", k=60_000))
    rows = [(i, text[7 * i:]) for i in range(5)]
    stored, real = {}, sd.store
    monkeypatch.setattr(sd, "store", lambda df, name: stored.setdefault(name, real(df, name)))
    assert run(spark, rows, tmp_dir, parts=5) == brute(rows)
    assert stored["spans"].count() <= 4 * 4  # tasks, groups of rows
    assert stored["row-spans"].count() == 4


def test_spans_of_a_group_are_merged(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(sd, "MERGED", 50)
    monkeypatch.setattr(sd, "SPANS", 30)
    row, first = rng.integers(0, 9, 2000) << 33, rng.integers(0, 5000, 2000)
    last = first + rng.integers(50, 70, 2000)
    spans = [sd._spans(*(x[i:i + 20] for x in (row, first, last))) for i in range(0, 2000, 20)]
    packed = pa.Table.from_batches(sd.pack_spans(iter(spans), 4)).sort_by("row").to_batches()
    got = {r["row"]: np.frombuffer(r["spans"], np.int64).reshape(-1, 2).tolist()
           for b in sd.merge_spans(iter(packed)) for r in b.to_pylist()}
    assert len(got) == 9
    for x, found in got.items():
        covered = {p for a, b in zip(first[row == x], last[row == x], strict=True) for p in range(a, b)}
        assert {p for a, b in found for p in range(a, b)} == covered
        assert all(b < c for (_, b), (c, _) in zip(found, found[1:], strict=False))


def test_odd_documents(spark, tmp_dir):
    rows = odd_rows()
    assert run(spark, rows, tmp_dir, SCHEMA) == brute([(r[0], r[1]) for r in rows])
    assert run(spark, [], tmp_dir + "e", SCHEMA) == Counter()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=6), min_size=1, max_size=40))
def test_blind_trie_orders_and_groups(texts):
    raw = [t.encode() for t in texts]
    trie = sd.BlindTrie(raw[0])
    for i, t in enumerate(raw[1:], 1):
        trie.insert(t, i)
    got = [[raw[i] for i in leaf] for leaf in trie.leaves()]
    assert all(len(set(leaf)) == 1 for leaf in got)
    assert [leaf[0] for leaf in got] == sorted(set(raw))
    assert sum(map(len, got)) == len(raw)


def test_blobs_round_trip():
    rng = np.random.default_rng(0)
    size = rng.integers(50, 93, 40)
    count = rng.integers(1, 4, 40)
    n = int(count.sum())
    columns = (rng.integers(0, 256, size.sum()).astype(np.uint8), size, rng.integers(0, 43, 40),
               rng.integers(-2**62, 2**62, 40), count, np.arange(n) + (7 << 33), rng.integers(0, 9, n))
    for a, b in zip(sd.unpack(sd.pack(*columns)), columns, strict=True):
        assert a.tolist() == b.tolist()
