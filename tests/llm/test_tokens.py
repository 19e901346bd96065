"""Token counts, token files and packing against the tokenizer library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martforge.llm import packing, token_counts, token_files
from martforge.llm.common import slices
from martforge.llm.queries import tokenizer_path
from martforge.llm.units import UnitEncoder

FILES = {"keep": "byte_bpe_50k.json", "drop": "word_bpe_49k.json"}
LIBRARY = {k: Tokenizer.from_file(tokenizer_path(v)) for k, v in FILES.items()}
ENCODERS = {k: UnitEncoder(tokenizer_path(v), k, limit=50) for k, v in FILES.items()}


def library_ids(kind, text):
    return LIBRARY[kind].encode(text or "", add_special_tokens=False).ids


TEXT = st.text(st.sampled_from("aB é.,'s \n\t\r\x0b\x1c\x85  0İß<|>日́")) | st.text()


@pytest.mark.parametrize("kind", ["keep", "drop"])
@settings(max_examples=1500, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=8))
def test_unit_ids_equal_the_library(kind, texts):
    got = [x.tolist() for x in ENCODERS[kind].ids(pa.array(texts))]
    assert got == [library_ids(kind, t) for t in texts]


@pytest.mark.parametrize("kind", ["keep", "drop"])
def test_known_tier_and_slices(kind):
    enc = UnitEncoder(tokenizer_path(FILES[kind]), kind, counts=True, limit=3)
    texts = [r[1] or "" for r in odd_rows()]
    want = [len(library_ids(kind, t)) for t in texts]
    assert enc.count(pa.array(texts)).tolist() == want
    enc.known = {u: enc.encode_unit(u) for u in ("word", " word", "lorem", " lorem")}
    assert enc.count(pa.array(texts).slice(3)).tolist() == want[3:]


def test_full_cache_keeps_units_still_in_use(monkeypatch):
    enc = UnitEncoder(tokenizer_path(FILES["drop"]), "drop", limit=20)
    asked, encode = Counter(), enc.encode_unit
    monkeypatch.setattr(enc, "encode_unit", lambda u: (asked.update([u]), encode(u))[1])
    for i in range(100):
        assert [x.tolist() for x in enc.ids(pa.array([f"common rare{i}x"]))] == [
            library_ids("drop", f"common rare{i}x")]
        assert len(enc.cache) + len(enc.older) <= 20
    assert asked["common"] == 1 and len(asked) == 101


def test_slices_hold_bounded_texts():
    texts = ["a" * 30, None, "b" * 500, "", *["c" * 10] * 40]
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": range(len(texts))})
    parts = list(slices([batch.slice(0, 0), batch, batch.slice(3)], size=100))
    assert [x for p in parts for x in p.column("n").to_pylist()] == [*range(44), *range(3, 44)]
    assert all(p.num_rows == 1 or len("".join(t or "" for t in p.column("text").to_pylist()[1:])) <= 100
               for p in parts)
    assert len(parts) > 8


@pytest.mark.parametrize("rows", [0, 1, 37])
def test_packing_cuts_a_batch_in_slices(spark, monkeypatch, rows):
    docs = spark.createDataFrame([(i, f"word{i} " * 40) for i in range(rows)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: seen.append(f))
    packing.cut_pieces(docs, tokenizer_path(FILES["drop"]), "drop", 0, 16)
    monkeypatch.setattr("pyspark.TaskContext.get", staticmethod(lambda: type("T", (), {"partitionId": lambda s: 3})()))
    monkeypatch.setattr(packing, "SLICE_BYTES", 1000)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(rows), pa.int64()),
                                        "text": pa.array([f"word{i} " * 40 for i in range(rows)], pa.string())})
    parts = list(seen[0](iter([batch])))
    assert len(parts) >= rows // 4 and {x for p in parts for x in p.column("doc_id").to_pylist()} == set(range(rows))
    places = Counter((n, k) for p in parts for n, k in zip(
        p.column("length").to_pylist(), p.column("place").to_pylist(), strict=True))
    assert set(places.values()) <= {1}


def test_token_counts(spark):
    got = token_counts.token_counts(odd_docs(spark), tokenizer_path(FILES["drop"]), "drop", 2048)
    want = Counter((r[0], len((r[1] or "").encode()), n := len(library_ids("drop", r[1])), n > 2048)
                   for r in odd_rows())
    assert Counter(map(tuple, got.collect())) == want
    assert token_counts.token_counts(odd_docs(spark, []), tokenizer_path(FILES["drop"]),
                                     "drop", 9).count() == 0


def test_frequent_units_merge_many_tasks(spark):
    docs = spark.createDataFrame([(f"common{i % 5} rare{i}",) for i in range(400)], "text string")
    found = token_counts.frequent_units(docs.repartition(40), "drop", table_size=5)
    assert set(found) == {f"common{i}" for i in range(5)}


@given(st.lists(st.integers(0, 2**32 - 1), max_size=60), st.integers(1, 9), st.integers(0, 100))
@settings(max_examples=200, deadline=None)
def test_segment_round_trip(values, block, percentile):
    ids = np.array(values, np.uint32)
    image = token_files.encode_segment(ids, block, percentile)
    assert token_files.decode_segment(image).tolist() == values
    for a in range(0, len(values), 7):
        assert token_files.decode_segment(image, a, a + 5).tolist() == values[a:a + 5]


def test_segment_is_smaller_than_plain_ids():
    ids = np.random.default_rng(1).integers(0, 900, 100_000).astype(np.uint32)
    ids[::97] += 40_000  # outliers go to the exception lists
    assert len(token_files.encode_segment(ids)) < 0.4 * ids.nbytes


def test_token_files(spark, monkeypatch):
    files = token_files.write_token_files(odd_docs(spark).repartition(3),
                                          tokenizer_path(FILES["keep"]), "keep", 2)
    got = [tuple(r)[:4] for r in token_files.read_token_files(files).orderBy("start").collect()]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert [g[1] for g in got] == [sum(g[2] for g in got[:i]) for i in range(len(got))]
    want = Counter()
    for r in odd_rows():
        tokens = np.array([*library_ids("keep", r[1]), 2], "<u4")
        want[r[0], len(tokens), zlib.crc32(tokens.tobytes())] += 1
    assert Counter((g[0], g[2], g[3]) for g in got) == want
    empty = token_files.write_token_files(odd_docs(spark, []), tokenizer_path(FILES["keep"]),
                                          "keep", 2)
    assert token_files.read_token_files(empty).count() == 0


def test_pack(spark):
    cap = 64
    placed, pieces = packing.pack(odd_docs(spark).repartition(4), tokenizer_path(FILES["drop"]),
                                  "drop", 0, cap)
    rows = placed.collect()
    want = Counter()
    for r in odd_rows():
        tokens = np.array([*library_ids("drop", r[1]), 0], "<u4")
        for piece, start in enumerate(range(0, len(tokens), cap)):
            part = tokens[start:start + cap]
            want[r[0], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // cap) + 2
    seqs = packing.sequences(placed, pieces).collect()
    assert len(seqs) == len(bins) and sum(len(s.ids) for s in seqs) == 4 * total
    none, _ = packing.pack(odd_docs(spark, []), tokenizer_path(FILES["drop"]), "drop", 0, cap)
    assert none.count() == 0


def brute_fullest(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    return max(sums)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fullest_is_the_best_sum(counts, room):
    chosen = packing.fullest(counts, room)
    assert all(n <= counts[k] for k, n in chosen.items())
    assert sum(k * n for k, n in chosen.items()) == brute_fullest(counts, room)


def test_plan_does_not_grow_with_the_counts():
    few = packing.plan_bins({k: 3 + k % 5 for k in range(1, 200)}, 200)
    many = packing.plan_bins({k: 10**9 * (3 + k % 5) for k in range(1, 200)}, 200)
    assert len(many) < 3 * len(few) + 500
