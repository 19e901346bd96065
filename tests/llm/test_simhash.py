"""SimHash classes against brute force."""

import random
import re
from collections import Counter

import numpy as np
import xxhash
from cases import odd_docs, odd_rows

from martforge.llm import simhash
from martforge.llm.components import components
from pyspark.sql import functions as F


def plain_fingerprint(text, k=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(prints, bits=4):
    """(id, fingerprint) rows -> id -> smallest id reachable"""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array([p for _, p in prints], np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= bits):
            root[find(i)] = find(int(j))
    best = {}
    for i, (d, _) in enumerate(prints):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(find(i)) for i in range(len(prints))]


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(3)
    for width in (23, 18):
        x = rng.integers(0, 1 << width, 3000).astype(np.uint32)
        for flips in (0, 1, 2):
            y = x.copy()
            for i in range(len(y)):
                for b in rng.choice(width, flips, replace=False):
                    y[i] ^= np.uint32(1 << int(b))
            (a, ua), (b, ub) = simhash.segment_keys(x, width), simhash.segment_keys(y, width)
            for i in range(len(x)):
                assert set(a[i][ua[i]]) & set(b[i][ub[i]])


def test_golay_code_is_perfect():
    table = simhash.golay_table()
    assert np.bincount(table).tolist() == [2048] * 4096


def test_fingerprints():
    for _, text, *_ in odd_rows():
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def _clustered(n_random, rng):
    prints = [rng.getrandbits(64) for _ in range(n_random)]
    for _ in range(12):  # chains and clusters around random centres
        at = rng.getrandbits(64)
        for _ in range(rng.randint(2, 40)):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                at ^= 1 << b
            prints.append(at)
    centre = rng.getrandbits(64)
    for _ in range(300):  # one dense cluster
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        prints.append(x)
    return prints + prints[:50]


def test_classes_equal_brute_force(spark):
    prints = list(enumerate(_clustered(1500, random.Random(11))))
    rows = [(d, np.uint64(p).astype(np.int64).item()) for d, p in prints]
    df = spark.createDataFrame(rows, "doc_id long, fp long").repartition(5)
    got = {r.fp: r.component_id for r in simhash.classes(df).collect()}
    want = plain_classes(prints)
    assert [got[fp] for _, fp in rows] == want
    assert 1 < len(set(want)) < len(prints)


def test_near_duplicates_of_odd_documents(spark):
    got = simhash.near_duplicates(odd_docs(spark))
    prints = [(r[0], plain_fingerprint(r[1])) for r in odd_rows()]
    want = Counter((d, f"{p:016x}", c)
                   for (d, p), c in zip(prints, plain_classes(prints), strict=True))
    assert Counter(map(tuple, got.collect())) == want
    assert simhash.near_duplicates(odd_docs(spark, [])).count() == 0


def test_one_per_class(spark):
    docs = odd_docs(spark)
    kept = simhash.one_per_class(docs)
    assert kept.columns == docs.columns
    prints = [(r[0], plain_fingerprint(r[1])) for r in odd_rows()]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(plain_classes(prints)))


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.union(spark.createDataFrame([(1000, 1001), (1001, 1000), (7, 7)], links.schema))
    got = {r.node: r.root for r in components(links.repartition(7)).collect()}
    assert got == {i: 0 for i in range(61)} | {1000: 1000, 1001: 1000}
    assert components(links.limit(0)).count() == 0
