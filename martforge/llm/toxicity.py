"""Toxicity scores of restored text.

1. Character trigrams are counted over all documents.
2. Disguised words (look-alikes, repetition, spacing) are restored by
   :mod:`martforge.llm.deobfuscate` under that model; other words have a
   lattice with a single path and stay as they are. Words glued together or
   wrapped in marks count as the words they consist of.
3. A text's features are its distinct restored words and their first four and
   five letters. A logistic regression over at most ``MAX_FEATURES`` of them
   is fitted on at most ``SAMPLE_ROWS`` labelled training rows (those with the
   smallest hashes of their ids), a bounded sample whatever the table's size.

Rows whose ``crc32(doc_id) mod 4`` is 2 are held out: their labels are never
read. Labels, language, source and id are never inputs of a score.

Cases: NULL or empty text has no features and gets the base rate's score;
repeated rows get equal scores; a NULL id is not held out; without labelled
rows of both classes every score is 0; an empty table gives an empty result;
other columns are ignored (and kept by :func:`accepted`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text, slices, store
from .deobfuscate import PLAIN_EDGE, SPACED_HINT, SYMBOLS, Restorer, trigram_counts

THRESHOLD = 0.3
HELD_OUT = 2
SAMPLE_ROWS = 10_000
MAX_FEATURES = 512
#: A feature must be this strongly associated with the label (G statistic).
MIN_G = 30.0
MIN_POSITIVES = 4
RIDGE = 0.1
SLICE_ROWS = 1000
#: Two equal letters in a word of a-z (RE2 has no back-references).
DOUBLED = "|".join(2 * chr(c) for c in range(97, 123))

_WORKER: dict[str, tuple] = {}


@dataclass
class Model:
    """A fitted scorer: trigram counts, feature weights, intercept."""

    trigrams: np.ndarray
    weights: dict[str, float]
    bias: float


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def word_features(word: str) -> list[str]:
    return [word, f"4 {word[:4]}", f"5 {word[:5]}"] if word else []


def count_trigrams(texts: DataFrame) -> np.ndarray:
    """Character trigram counts over all rows of ``texts`` (``text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in slices(batches):
            total += trigram_counts(batch.column("text").to_pylist())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"trigram": pa.array(used, pa.int64()),
                                          "n": pa.array(total[used], pa.int64())})

    rows = (texts.select("text").mapInArrow(count, "trigram long, n long")
            .groupBy("trigram").agg(F.sum("n").alias("n")).collect())  # at most SYMBOLS ** 3
    out = np.zeros(SYMBOLS ** 3, np.int64)
    for r in rows:
        out[r["trigram"]] = r["n"]
    return out


def _features(texts: list[str], restorer: Restorer) -> Iterator[list[str]]:
    for text in texts:
        words = {w for shown in set(text.lower().split()) for w in restorer.words(shown)}
        words.update(restorer.restore_spaced(text))
        yield sorted({f for w in words for f in word_features(w)})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the training rows of ``labels`` (``doc_id``, ``toxic``)."""
    spark, texts = docs.sparkSession, id_text(docs)
    trigrams = count_trigrams(texts)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .filter(remainder(F.col("doc_id")) != HELD_OUT)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    shared = spark.sparkContext.broadcast(trigrams)  # SYMBOLS ** 3 counts

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array(list(_features(batch.column("text").to_pylist(), restorer)),
                          pa.list_(pa.string()))], ["doc_id", "toxic", "features"])

    # the sample has at most `sample_rows` rows
    sample = store(texts.join(F.broadcast(known), "doc_id")
                   .mapInArrow(featurize, "doc_id long, toxic int, features array<string>"),
                   "toxicity-sample")
    sums = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).first()
    n, pos = sums["n"], sums["pos"] or 0
    if not 0 < pos < n:
        return Model(trigrams, {}, -np.inf)
    each = (sample.select("toxic", F.explode("features").alias("f")).groupBy("f")
            .agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("k"))
            .filter(F.col("a") >= MIN_POSITIVES))

    def part(found: Column, expected: Column) -> Column:
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    a, k = F.col("a").cast("double"), F.col("k").cast("double")
    g = 2 * (part(a, k * pos / n) + part(k - a, k * (n - pos) / n)
             + part(pos - a, (n - k) * pos / n) + part(n - k - (pos - a), (n - k) * (n - pos) / n))
    chosen = [r["f"] for r in each.filter(a / k > pos / n).withColumn("g", g)
              .filter(F.col("g") >= MIN_G).orderBy(F.desc("g"), "f").limit(MAX_FEATURES).collect()]
    number = {f: i for i, f in enumerate(chosen)}
    wanted = F.array(*map(F.lit, chosen)) if chosen else F.array().cast("array<string>")
    rows = sample.select("toxic", F.array_intersect("features", wanted).alias("f")).collect()
    x = np.zeros((len(rows), len(chosen) + 1))
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, [number[f] for f in r["f"]]] = 1
    w = fit_logistic(x, np.array([r["toxic"] for r in rows], float))
    return Model(trigrams, dict(zip(chosen, w[:-1].tolist(), strict=True)), float(w[-1]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last column of
    ``x`` is the unpenalised intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curvature, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


class Scorer:
    """Scores texts under a model; keeps the weights of words seen before: at
    most ``limit`` of those that need decoding, the longest unused go first."""

    def __init__(self, model: Model, limit: int = 150_000) -> None:
        self.model, self.limit = model, limit
        self.restorer = Restorer(model.trigrams)
        self.cache: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}
        # the weighted words, and their weighted first 4 and 5 letters
        self.whole = pa.array([f for f in model.weights if " " not in f], pa.string())
        self.starts = {n: pa.array([f[2:] for f in model.weights if f.startswith(f"{n} ")],
                                   pa.string()) for n in (4, 5)}

    def word(self, word: str) -> tuple[str, ...]:
        """The weighted features of a white-space-delimited word."""
        found = self.cache.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                weights = self.model.weights
                found = tuple(f for w in self.restorer.words(word) for f in word_features(w)
                              if f in weights)
            if len(self.cache) >= max(1, self.limit // 2):
                self.older, self.cache = self.cache, {}
            self.cache[word] = found
        return found

    def words(self, cores: pa.Array) -> tuple[np.ndarray, dict[int, tuple[str, ...]]]:
        """Of distinct lower-case words without marks at their ends: which have
        weighted features, and these by place."""
        single = pc.and_(pc.match_substring_regex(cores, r"\A[a-z]+\z"),
                         pc.invert(pc.match_substring_regex(cores, DOUBLED)))
        hit = pc.is_in(cores, self.whole)  # one path in the lattice: the word itself
        for n, starts in self.starts.items():
            hit = pc.or_(hit, pc.is_in(pc.utf8_slice_codeunits(cores, 0, n), starts))
        todo = pc.or_(hit, pc.invert(single)).to_numpy(zero_copy_only=False)
        features = {}
        for i, core in zip(np.flatnonzero(todo).tolist(),
                           cores.filter(pa.array(todo)).to_pylist(), strict=True):
            found = self.word(core)
            if found:
                features[i] = found
        mask = np.zeros(len(cores), bool)
        mask[list(features)] = True
        return mask, features

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        spaced = pc.match_substring_regex(texts, SPACED_HINT).to_pylist()
        plain = texts.to_pylist()
        for a, b in chunks(plain):
            lists = [t.lower().split() for t in plain[a:b]]
            sizes = np.fromiter(map(len, lists), np.int64, b - a)
            shown = pa.array([w for words in lists for w in words], pa.string()).dictionary_encode()
            cores = pc.utf8_trim(shown.dictionary, characters=PLAIN_EDGE).dictionary_encode()
            hit, found = self.words(cores.dictionary)
            number = cores.indices.to_numpy()[shown.indices.to_numpy()]
            owner = np.repeat(np.arange(b - a), sizes)
            where = np.flatnonzero(hit[number])
            features: list[set] = [set() for _ in range(b - a)]
            for doc, n in zip(owner[where].tolist(), number[where].tolist(), strict=True):
                features[doc].update(found[n])
            for i in range(b - a):
                if spaced[a + i]:
                    for w in self.restorer.restore_spaced(plain[a + i]):
                        features[i].update(f for f in word_features(w) if f in self.model.weights)
                out[a + i] = sum(self.model.weights[f] for f in sorted(features[i]))
        if self.model.bias == -np.inf:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(out + self.model.bias, -500, 500)))


def _scorer(key: str, shared) -> Scorer:
    """This worker's scorer of a broadcast model."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Scorer(shared.value)
    return _WORKER[key]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scorer.scores(batch.column("text")))],
                ["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score is below ``threshold``."""
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)
        for batch in _slices(batches):
            texts = pc.fill_null(batch.column(text_col), "")
            yield batch.filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
