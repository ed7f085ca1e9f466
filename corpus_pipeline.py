"""Corpus cleaning: language ID, exact dedup, near-duplicate join, benchmark decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import decontaminate, exact_dedup, langid, ngram_join, sentencepiece_fst
from graphloom.llm.common import table
from graphloom.session import shared_path


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach; texts without a letter go."""
    return langid.in_a_language(docs)


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of texts that are equal but for blanks stays."""
    return exact_dedup.drop_duplicates(docs)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.drop_near_duplicates(docs)


def off_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, decoded_sha256, exact) of what is left."""
    return sentencepiece_fst.round_trip(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", in_a_language),
    ("exact_dedup", unique_texts),
    ("ngram_join", unlike_texts),
    ("decontaminate", off_benchmark),
    ("sentencepiece", encoded),
]

# language identification, similarity classes and encoding are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
