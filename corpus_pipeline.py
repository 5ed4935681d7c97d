"""The corpus pipeline: stages over documents, each written and read again before the next.

A stage takes ``(spark, docs, sf_dir)`` and returns the columns of documents for the rows it keeps;
the last returns packed pieces.  Columns that documents have beyond ``doc_id`` and ``text`` are
passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, table, temporary
from ledgerloom.llm.decontaminate import few, phrase_matches
from ledgerloom.llm.near_dedup import drop_near_duplicates
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.pii import redact_personal_data
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.llm.toxicity import drop_toxic, fit_toxicity

SHINGLE = 5  # words in a row; op6's own contract says 4
MOST_IDS = 1_000_000  # of documents that are broadcast, 8 MB; beyond that the join shuffles


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not take for toxic."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, by shingles of 5 words, the document with the smallest id."""
    return drop_near_duplicates(docs, size=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    with temporary(spark):
        found = phrase_matches(docs, table(spark, sf_dir, "benchmark"))
        hit = stored(found.select(F.col("doc_id").alias("_hit")).distinct(), "contaminated", lasting=True)
    hit = few(hit, MOST_IDS)
    return docs.join(hit, docs["doc_id"] == hit["_hit"], "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of personal data in place of each span."""
    return redact_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences; one row per piece."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Fitted models and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
