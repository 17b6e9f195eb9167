"""Queries of the operators in this subpackage, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontaminate, htmltext, langid, licenses, linededup, orderminhash, packing, periodic, quality, simhash, tokenfiles, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read(*tokenfiles.write(_table(spark, sf_dir, "documents")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.fingerprint(_table(spark, sf_dir, "documents"))


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations"))))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse(_table(spark, sf_dir, "documents"), loop=True, text=False).drop("runs", "collapsed")


_ALL = (
    op1_simhash_near_dedup,
    op2_benchmark_decontamination,
    op3_token_files,
    op4_best_fit_packing,
    op5_warc_archive,
    op6_license_scan,
    op7_line_dedup,
    op8_order_minhash,
    op9_html_main_text,
    op10_quality_classifier,
    op11_conversation_repair,
    op12_language_id,
    op13_periodic_runs,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": linededup.SQL}
