"""The pipeline's stages against brute force on a small corpus."""

import random
import re
from collections import Counter

import pytest
from cases import odd_docs
from test_pii import CARD, base_spans
from test_simhash import plain_classes, plain_fingerprint
from test_tokens import LIBRARY

import corpus_pipeline
from martforge.llm import decontaminate, toxicity

SYLLABLES = ["the", "on", "er", "ing", "ed", "an", "ea", "tion", "re", "st", "ou", "ly", "wh", "ha"]
ITEMS = None


def make_corpus():
    rng = random.Random(17)
    text = lambda n: " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
                              for _ in range(n))
    items = [(i, text(30)) for i in range(6)]
    docs, labels = [], []
    for i in range(400):
        body, kind = text(rng.randint(1, 120)), i % 8
        if kind == 1:
            body += " you moron " + text(9) + " idiot"
        elif kind == 2 and docs:
            body = rng.choice(docs)[1]  # an exact copy
        elif kind == 3:
            body += " " + rng.choice(items)[1] + " " + text(20)
        elif kind == 4:
            body += f" mail a.b@c.org, +1 (555) 010-9999 or {CARD} from 10.0.0.9 " + text(5)
        docs.append((i, body))
        labels.append((i, 1, int(kind == 1 or "moron" in body)))
    docs += [(900, None), (901, "")]
    rows = [(d, t, "en", "s", None if t is None else len(t)) for d, t in docs]
    return rows, labels, items


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels, items = make_corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], folder).write.parquet(f"{folder}/out{k}")
        out.append(spark.read.parquet(f"{folder}/out{k}"))
    return out, folder, labels, items


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(stages):
    out = stages[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(df.schema == out[0].schema for df in out[:-1])


def test_toxicity(spark, stages):
    (docs, kept, *_), folder, labels, _ = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0}
    assert set(texts(kept)) == want
    bad = {d for d, _, y in labels if y}
    assert not bad & want and len(want) == len(texts(docs)) - len(bad)


def test_near_duplicates(stages):
    before, after = texts(stages[0][1]), texts(stages[0][2])
    rows = sorted(before.items())
    assert set(after) == set(plain_classes([(d, plain_fingerprint(t)) for d, t in rows]))
    assert all(after[d] == before[d] for d in after) and len(after) < len(before)


def test_decontamination(stages):
    before, after = texts(stages[0][2]), texts(stages[0][3])
    shingles = lambda t: decontaminate.shingles_of(decontaminate.words_of(t or ""))
    wanted = [shingles(t) for _, t in stages[3]]
    clean = {d for d, t in before.items()
             if not any(len(s & shingles(t)) >= 0.8 * len(s) for s in wanted)}
    assert set(after) == clean and len(clean) < len(before)


def test_personal_data(stages):
    before, after = texts(stages[0][3]), texts(stages[0][4])
    assert before.keys() == after.keys()
    for d, text in before.items():
        spans = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in base_spans(text)))
        want, at = "", 0
        for a, b, k in spans:
            if a >= at:
                want += text[at:a] + f"[{k}]"
            at = max(at, b)
        assert after[d] == want + (text or "")[at:]
    assert any("[card]" in t and not re.search("[0-9]{4} [0-9]{4}", t) for t in after.values())
    assert all(r.n_chars == len(r.text) for r in stages[0][4].collect())


def test_packing(stages):
    docs, rows = texts(stages[0][4]), stages[0][5].collect()
    want = Counter()
    for d, t in docs.items():
        n = len(LIBRARY["drop"].encode(t, add_special_tokens=False).ids) + 1
        for piece, start in enumerate(range(0, n, 2048)):
            want[d, piece, start, min(2048, n - start)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in rows) == want
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 2048) + 1


def test_run_equals_the_stages(spark, stages):
    got = Counter(map(tuple, corpus_pipeline.run(spark, stages[1]).select("doc_id", "length").collect()))
    assert got == Counter((r.doc_id, r.length) for r in stages[0][5].collect())


def test_odd_documents_pass_every_stage(spark, stages):
    for rows in (None, []):
        docs = odd_docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, stages[1])
            assert docs.count() > 0 or rows == []
