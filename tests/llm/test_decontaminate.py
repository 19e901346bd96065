"""Containment search against brute force."""

import random
from collections import Counter

from cases import odd_docs, odd_rows

from martforge.llm import decontaminate as dc


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgé0", k=rng.randint(2, 8))) for _ in range(900)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [make(n) for n in (1, 2, 4, 5, 6, 8, 9, 15, 16, 20, 33, 57, 64, 65, 120, 300) for _ in (0, 1)]
    items += ["", None, "...", items[5], items[9]]
    docs = []
    for i in range(150):
        parts = [make(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            words = (rng.choice(items) or "").split()
            for _ in range(rng.choice((0, 0, 1, 2))):  # damage it
                if words:
                    words[rng.randrange(len(words))] = "changed"
            parts += [", ".join([" ".join(words).upper()]), make(rng.randint(0, 300))]
        docs.append((i, "; ".join(parts)))
    docs += [(500, items[0]), (501, items[2]), (502, make(30_000) + " " + items[11]), (3, docs[3][1])]
    return docs, list(enumerate(items))


def brute(docs, items):
    out = Counter()
    held = [(d, dc.shingles_of(dc.words_of(t or ""))) for d, t in docs]
    for i, t in items:
        s = dc.shingles_of(dc.words_of(t or ""))
        for d, h in held:
            n = len(s & h)
            if s and n >= 0.8 * len(s):
                out[d, i, len(s), n] += 1
    return out


def test_pairs_equal_brute_force(spark, monkeypatch):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    got = Counter(tuple(r)[:4] for r in dc.contaminated(d, i).collect())
    assert got == want and len(want) > 60
    monkeypatch.setattr(dc, "BLOCK_BYTES", 1500)  # several blocks of items
    assert len(list(dc.item_blocks(i, "text"))) > 3
    assert Counter(tuple(r)[:4] for r in dc.contaminated(d, i).collect()) == want
    kept = Counter(r.doc_id for r in dc.clean_documents(d, i).collect())
    hit = {k[0] for k in want}
    assert kept == Counter(x for x, _ in docs if x not in hit)


def test_hashes_follow_the_words():
    texts = [r[1] or "" for r in odd_rows()]
    hashes, owner = dc.shingle_hashes(texts)
    seen = {}
    for n, t in enumerate(texts):
        words = dc.words_of(t)
        want = [b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        mine = hashes[owner == n].tolist()
        assert len(mine) == len(want)
        for h, s in zip(mine, want, strict=True):
            assert seen.setdefault(h, s) == s
    assert len(set(seen.values())) == len(seen)


def test_odd_documents(spark):
    items = [(1, odd_rows()[15][1]), (None, "no id at all"), (2, None), (3, ""), (3, "x\x1cy z")]
    d, i = odd_docs(spark), spark.createDataFrame(items, "item_id long, text string")
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert Counter(tuple(r)[:4] for r in dc.contaminated(d, i).collect()) == brute(rows, items)
    assert dc.clean_documents(d, i).columns == d.columns
    empty = i.limit(0)
    assert dc.contaminated(d, empty).count() == 0
    assert dc.contaminated(odd_docs(spark, []), i).count() == 0
    assert dc.clean_documents(d, empty).count() == d.count()


def test_index_of_a_whole_block_is_small():
    import tracemalloc
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=rng.randint(3, 9))) for _ in range(5000)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(20, 120))) for _ in range(8000)]
    size = sum(map(len, items))
    tracemalloc.start()
    index = dc.ItemIndex(items)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 20 * size and peak * dc.BLOCK_BYTES / size < 600e6
    assert sorted(i for _, i, _ in index.matches([" ".join(items[5:9])])) == [5, 6, 7, 8]
