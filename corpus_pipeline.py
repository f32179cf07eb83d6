"""Corpus pipeline: toxicity, near-dedup, substring dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. All but
the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
A text that a stage changes keeps its row, and ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import line_dedup, near_texts, packing, secrets_forest, toxicity
from slotwise.llm.common import durable, table

#: A stage is a classifier, a clustering or a tokenizer, so SQL cannot express the whole.
ORACLE_SQL = None


def _with_lengths(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=tuple(c for c in docs.columns if c != "doc_id"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a Jaccard similarity of 0.8 over five-word shingles the one with the least id stays; of repeated rows of it, one.

    What op2's fingerprints or a MinHash key bring together is compared exactly.
    """
    return near_texts.firsts(docs, more=near_texts.fingerprint_keys(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go from the text."""
    return _with_lengths(line_dedup.clean(docs), docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text give way to a mark."""
    return _with_lengths(secrets_forest.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return packing.digest(docs)
