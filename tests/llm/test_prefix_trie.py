"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from martforge.llm import parentheses as bp
from martforge.llm import prefix_trie as pt

SCHEMA = ("conv_id long, turn int, role string, text string, digest int, level string, "
          "`rank` int, chars int, start string, layer int")


def rebuilt(rows, openings):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in turns.items()}
    if not openings:
        return said
    out = {}
    for c, mine in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = said.get(c - c % 100, [])[:h] + mine[h:]
    return out


def brute(rows, openings=True):
    convs = rebuilt(rows, openings)
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = set()
    total = {}
    for p in sorted(members, key=len, reverse=True):
        below = [total[q] for q in children.get(p, [])]
        leaves = sum(x for x, _ in below) or 1
        saved = sum(x for _, x in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        total[p] = (leaves, saved)
        ids = ",".join(map(str, sorted(ends.get(p, []))))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
                 len(children.get(p, [])), leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
    return out


def run(spark, rows, openings=True, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4) for r in rows], SCHEMA).repartition(parts)
    turns = pt.numbered_turns(df)
    found = pt.prefix_trie(*(pt.shared_openings if openings else pt.whole_conversations)(turns)).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def random_rows(rng, n, width=3, longest=9):
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"])[: width + 9], "é" * rng.randint(0, width - 1)))
    return rows


def test_balanced_parentheses(monkeypatch):
    rng = random.Random(1)
    for block in (4, 16, 256) * 10:
        monkeypatch.setattr(bp, "BLOCK", block)
        monkeypatch.setattr(bp, "SLICE", rng.choice([3, 8192]))
        paths = sorted({tuple(rng.randint(0, 2) for _ in range(rng.randint(0, 9))) for _ in range(60)})
        words = np.array([[x, 0] for p in paths for x in p], np.uint64).reshape(-1, 2)
        trie = bp.Trie(words, np.array([len(p) for p in paths]))
        nodes = sorted({p[:k] for p in paths for k in range(len(p) + 1)})
        under = [[j for j, q in enumerate(nodes) if q[: len(p)] == p] for p in nodes]
        assert trie.last.tolist() == [u[-1] + 1 for u in under]
        assert trie.parent.tolist() == [nodes.index(p[:-1]) if p else -1 for p in nodes]
        leaf = [len(u) == 1 for u in under]
        assert trie.leaves().tolist() == [sum(leaf[j] for j in u) for u in under]
        weights = np.arange(len(nodes)) ** 2
        assert trie.below(weights).tolist() == [int(weights[u].sum()) for u in under]
        assert trie.least(weights[::-1]).tolist() == [int(weights[::-1][u].min()) for u in under]


@pytest.mark.parametrize("layer, shard", [(128, 250_000), (3, 7), (2, 100), (128, 5)])
def test_against_brute_force(spark, monkeypatch, layer, shard):
    monkeypatch.setattr(pt, "LAYER", layer)
    monkeypatch.setattr(pt, "SHARD_TURNS", shard)
    monkeypatch.setattr(pt, "CHUNK_IDS", 3)
    rng = random.Random(layer * shard)
    rows = random_rows(rng, 150, 2, 8)
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(5)]  # one hot conversation
    assert run(spark, rows) == brute(rows)


def test_long_and_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(pt, "LAYER", 16)
    rows = [(7, t, "user", f"t{t % 3}") for t in range(300)]
    rows += [(8, t, "user", f"t{t % 3}") for t in range(290)]
    rows += [(9, t, "user", f"t{t % 3}" if t < 200 else "x") for t in range(260)]
    rows += [(10, None, None, None), (10, None, "", ""), (10, 1, "a", "b"), (10, 1, "a", "b"),
             (None, 1, "user", "lost"), (11, 5, "us", "er1"), (12, 5, "use", "r1"), (-5, 1, "user", "t0")]
    rows += [(401, 1, "user", "only one")]  # may be left without turns
    assert run(spark, rows, openings=False) == brute(rows, openings=False)
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert run(spark, positive) == brute(positive)


def test_empty(spark):
    assert run(spark, []) == set()
    assert run(spark, [(None, 1, "user", "x")]) == set()
