"""Restoration of disguised words, held-out accuracy, and odd documents."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from cases import odd_docs, odd_rows

from martforge.llm import toxicity as tox
from martforge.llm.deobfuscate import SPACED_HINT, SYMBOLS, Restorer, symbol_of, trigram_counts

BAD = ["moron", "idiot", "stupid", "loser", "disgusting"]
SYLLABLES = ["the", "on", "er", "ing", "ed", "an", "ea", "tion", "re", "st", "ou", "ly", "wh"]


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return d, labels, tox.fit(d, label)


def test_trigram_counts_by_hand():
    got = trigram_counts(["ab a1", ""])
    want = np.zeros(SYMBOLS ** 3, np.int64)
    for text in ("ab a1", ""):
        seq = []
        for c in "  " + text + "  ":
            seq += [0, 0] if symbol_of(c) == 0 else [symbol_of(c)]
        for x, y, z in zip(seq, seq[1:], seq[2:], strict=False):
            want[x * SYMBOLS ** 2 + y * SYMBOLS + z] += 1
    assert (got == want).all()


def test_disguises_are_undone(fitted):
    r = Restorer(fitted[2].trigrams)
    for shown, meant in {"m0r0n": "moron", "1d10t": "idiot", "stuuuupid!": "stupid",
                         "$tup1d": "stupid", "LOSER": "loser", "l0$er,": "loser",
                         "d-i-s-g-u-s-t-i-n-g": "disgusting", "the!!": "the",
                         "": "", "123": "123", "...": ""}.items():
        assert r.restore_word(shown) == meant
    assert r.restore_spaced("the i d i o t, l.o.s.e.r and a b") == ["idiot", "loser"]
    assert len(r.restore_word("4" * 5000 + "a")) > 0


@pytest.mark.parametrize("shown,meant", [
    ("you i d ! o t now", "idiot"), ("a $ t u p i d one", "stupid"), ("(l o s e r)", "loser"),
    ('"i d i o t"', "idiot"), ("i  d  i  o  t", "idiot"), ("«l-0-s-3-r»", "loser"),
    ("such [s__t__u__p__1__d]!", "stupid"), ("! d 1 0 t", "idiot")])
def test_spaced_disguises_are_undone(fitted, shown, meant):
    assert meant in Restorer(fitted[2].trigrams).restore_spaced(shown)
    assert pc.match_substring_regex(pa.array([shown]), SPACED_HINT).to_pylist() == [True]


def test_every_ambiguous_word_is_decoded(fitted):
    r = Restorer(fitted[2].trigrams)
    for shown, meant in {"iddiot": "idiot", "stuupid": "stupid", "looser": "loser",
                         "!d10t": "idiot", "(l0$er)": "loser", "$7": "st", "m0r0n!": "moron"}.items():
        assert r.restore_word(shown) == meant
    # a corpus of the word itself: the look-alike at its start is a letter
    r = Restorer(trigram_counts(["cunt"] * 50 + ["ass"] * 50))
    assert r.restore_word("(un7") == "cunt" and r.restore_word("@$$") == "ass"


def test_decode_is_the_cheapest_reading(fitted):
    r = Restorer(fitted[2].trigrams)

    def cost(reading, channel):
        x, y, total = 0, 0, channel
        for c in reading + " ":
            z = symbol_of(c)
            total += r.cost[x][y][z]
            x, y = y, z
        return total

    for word in ("1d10t", "a$$", "l-o", "m00n3", "t|p"):
        readings = [("", 0.0)]
        for step in r.options(word):
            readings = [(a + b, p + q) for a, p in readings for b, q in step]
        best = min(cost(a, p) for a, p in readings)
        got = r.decode(word)
        assert min(cost(a, p) for a, p in readings if a.strip() == got) == pytest.approx(best)


def test_held_out_accuracy(spark, fitted):
    d, labels, model = fitted
    rows = {r.doc_id: r for r in tox.score(d, model).collect()}
    held = [(rows[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in rows.values()) == len(held)
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    disguised = spark.createDataFrame(
        [(1, "the thing is a m0r0n and an 1d10t er"), (2, "you l o s e r and s.t.u.p.i.d one"),
         (3, "the thing is er and an on er"), (4, "THE!!! $5 and 100 re")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in tox.score(disguised, model).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}
    assert {r.doc_id for r in tox.accepted(disguised, model).collect()} == {3, 4}


@pytest.mark.parametrize("shown", [
    "end.idiot", "so-idiot", "such-an-idiot", "the,idiot", "well/idiot", "*idiot*", "_idiot_",
    "#idiot", "<b>idiot</b>", "(idiot)", "er!idiot", "the.1d10t", "**1d10t**", "!d10t", "2idiot"])
def test_glued_and_wrapped_words(fitted, shown):
    model = fitted[2]
    assert "5 idiot" in model.weights
    assert "5 idiot" in tox.Scorer(model).word(shown)
    assert "5 idiot" in next(tox._features([f"the {shown} on"], Restorer(model.trigrams)))


def test_held_out_labels_are_never_read(spark, fitted):
    d, labels, model = fitted
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in labels]
    other = tox.fit(d, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert other.weights == pytest.approx(model.weights)


def test_odd_documents(spark, fitted):
    docs, model = odd_docs(spark), fitted[2]
    rows = tox.score(docs, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows())
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert tox.accepted(docs, model).columns == docs.columns
    assert tox.score(odd_docs(spark, []), model).count() == 0
    none = spark.createDataFrame([(None, 1, None), (3, 0, None)], "doc_id long, quality int, toxic int")
    empty = tox.fit(odd_docs(spark, []), none)
    assert [r.score for r in tox.score(docs.limit(3), empty).collect()] == [0.0] * 3
    assert tox.accepted(docs, empty).count() == docs.count()


def test_scores_equal_a_plain_reading(spark, fitted):
    d, _, model = fitted
    texts = {r.doc_id: r.text for r in d.collect()}
    got = {r.doc_id: r.score for r in tox.score(d, model).collect()}
    assert got.keys() == texts.keys()
    odd = {(r[0], r[1]) for r in odd_rows() if r[0] is not None}
    got_odd = {r.doc_id: r.score for r in tox.score(odd_docs(spark), model).collect()}
    pairs = [(t, got[i]) for i, t in texts.items()] + [(t, got_odd[i]) for i, t in odd]
    hits = 0
    for text, value in pairs:
        features = next(tox._features([text or ""], Restorer(model.trigrams)))  # nothing kept from other texts
        total = model.bias + sum(w for f, w in sorted(model.weights.items()) if f in features)
        assert value == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
        hits += any(f in model.weights for f in features)
    assert hits > 20


def test_words_are_decoded_once(fitted, monkeypatch):
    """Words with one reading need no lattice; case and outer marks make no
    other word; a full cache keeps the words in use."""
    model, asked, decode = fitted[2], [], Restorer.words
    texts = [f'The x{c}ston idiot, "Ering" 1d10t (1D10T). $tup1d{c} on' for c in "abcdefghijklmnop"]
    want = [next(tox._features([t], Restorer(model.trigrams))) for t in texts]
    monkeypatch.setattr(Restorer, "words", lambda self, w: asked.append(w) or decode(self, w))
    scorer = tox.Scorer(model, limit=8)
    got = np.concatenate([scorer.scores(pa.array([t])) for t in texts])
    total = [model.bias + sum(model.weights.get(f, 0) for f in features) for features in want]
    assert got == pytest.approx(1 / (1 + np.exp(-np.array(total))), abs=1e-9)
    assert sorted(w for w in asked if w != "idiot") == sorted(
        ["1d10t", "(1d10t", *(f"$tup1d{c}" for c in "abcdefghijklmnop")])
    assert asked.count("idiot") <= 1  # the only plain word that has weights


def test_decode_of_stretches_is_the_cheapest_reading(fitted):
    r = Restorer(fitted[2].trigrams)

    def cost(reading):
        seq = [0, 0, *map(symbol_of, reading + " ")]
        return sum(r.cost[x][y][z] for x, y, z in zip(seq, seq[1:], seq[2:], strict=False))

    for word in ("ththeere", "an-$tingedly", "ooner", "tionss", "rereoo.anst", "éa3éé", "ing''ed0"):
        readings = [("", 0.0)]
        for step in r.options(word):
            readings = [(a + b, p + q) for a, p in readings for b, q in step]
        best = min(cost(a) + p for a, p in readings)
        got = r.decode(word)
        assert min(cost(a) + p for a, p in readings if a.strip() == got) == pytest.approx(best)
