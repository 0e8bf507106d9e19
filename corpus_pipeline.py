"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that its predecessor kept, as they were written to Parquet,
and all but the last return documents with the same columns. What a stage learns, it learns from
its own input (and, for toxicity, from the labels table).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintally.llm.exact_dedup import drop_exact_copies
from twintally.llm.language import drop_unknown, fit_language
from twintally.llm.packing import pack_documents
from twintally.llm.scratch import Scratch
from twintally.llm.simhash import drop_near_copies
from twintally.llm.toxicity import drop_toxic, fit_toxicity, fold


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    return drop_toxic(docs, fit_toxicity(docs, labels))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: those without text or without a letter."""
    return drop_unknown(docs, fit_language(docs.where(fold(F.col("doc_id"), 3) != 1)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the document with the largest identifier."""
    return drop_exact_copies(docs, keep="largest")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, keeps the one with the smallest identifier."""
    return drop_near_copies(docs, shingle_words=4, most_distance=4)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
