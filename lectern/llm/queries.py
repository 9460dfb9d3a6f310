"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import (
    decontaminate,
    jaccard,
    language,
    lmscore,
    negatives,
    packing,
    pii,
    quality,
    tokencount,
    topk,
    toxicity,
    variants,
    warc,
)
from lectern.plans.storage import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


#: Where Python workers find this library when it is not installed on them.
_HOME = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", _HOME)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = materialize(docs.select("doc_id", pii.candidates().alias("found")), "pii")
    return pii.personal_data(found, pii.fit_spans(found))


@query
def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))
