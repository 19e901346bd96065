"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that works on
all that the stage before it kept; its result is written as Parquet and reread
as the next stage's ``docs``. All but the last return the columns of
``documents``.

1. ``toxicity``         rejected documents go
2. ``near_duplicates``  one document of each SimHash class stays (smallest id)
3. ``decontamination``  documents that hold a benchmark item go
4. ``personal_data``    personal data in the texts is replaced by its kind
5. ``packing``          the texts become sequences of at most 2048 tokens

Rows with NULL text are empty documents, NULL ids are kept as NULL, repeated
rows fall to stage 2, and empty tables pass through every stage. Further columns
pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import decontaminate, packing, pii, simhash, toxicity as toxic
from martforge.llm.common import store, table
from martforge.llm.queries import PACK_TOKENS, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.accepted(docs, toxic.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = docs.withColumn("text", pii.redact(F.coalesce("text", F.lit(""))))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed, _ = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), "drop", 0, PACK_TOKENS)
    return placed.drop("task", "place")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: A fitted classifier and XXH64 fingerprints have no SQL; tests/llm compares
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
