"""A training corpus from raw documents: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, linededup, packing, quality, simhash, store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, but from one document each."""
    return linededup.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    return simhash.keep_unlike(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences."""
    return packing.pack(docs)


STAGES = [(f.__name__, f) for f in (quality_classifier, line_dedup, simhash_near_dedup, benchmark_decontamination, best_fit_packing)]

#: SQL can't express a trained classifier, fingerprints or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on a table that holds what the one before it kept.

    Null texts are empty.  Each stage states what it does with null and
    repeated doc_ids; a stage without rows gives none, and columns that a stage
    doesn't know pass unchanged, but for the last stage.  Texts are worked on
    whole, however long.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.table(stage(spark, docs, sf_dir), name)
    return docs
