"""From raw documents to packed sequences: language, exact, near and substring dedup, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language
from millrace.llm.exact_dedup import drop_exact
from millrace.llm.near_dedup import drop_near
from millrace.llm.packing import pack
from millrace.llm.registry import table, unused
from millrace.llm.substring_dedup import without_repeats
from millrace.session import stage

ORACLE_SQL = None  # several stages cannot be expressed in SQL


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the declared language is ``lang``, the host is ``source``."""
    keep = unused(docs, "_keep")
    rows = docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"),
    )
    accepted = language.identify(rows, language.fit(docs)).where("accepted").select(F.col("id").alias(keep)).distinct()
    return docs.join(accepted, F.col("doc_id").eqNullSafe(F.col(keep)), "left_semi")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: word 5-grams, similarity of 0.8 or more."""
    return drop_near(docs, percent=80)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and passages that an earlier document has."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of related documents."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_content),
    ("substring_dedup", distinct_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
