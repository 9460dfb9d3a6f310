"""A training-corpus pipeline: the stages, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir), with docs in the columns of documents,
and returns a DataFrame; all but the last return the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontaminate, jaccard, language, packing, pii
from lectern.llm.queries import table, tokenizer_path
from lectern.plans.storage import materialize

#: Near copies of this stage; op4 has settings of its own.
NEAR = jaccard.JoinSettings(words=5, least=80, of=100)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in no language: without text or without letters."""
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of every group of linked texts.

    Texts link at a Jaccard similarity of 0.8 or more of their 5-word shingles.
    """
    return jaccard.keep_first(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that share a window of words with the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences: one row per piece."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packed", packed),
]

# The last two stages use a trained model and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
