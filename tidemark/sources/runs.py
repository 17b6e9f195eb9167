"""Run folders, toolchain manifests and snapshots as they lie on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules

RUN = (
    "run struct<mode: string, started_at: string, finished_at: string, snapshot_id: string, input: struct<sha256: string, input_status: string, discarded_packets: bigint>, "
    "counts: struct<rules_loaded: bigint, unmatched: bigint, unmatched_ratio: double>, ruleset: struct<total_admitted: bigint>, warnings: array<string>>, "
    "labels array<struct<flow: struct<uid: string>, sources: array<struct<source: string, sid: bigint, label_basis: string, classtype: string>>>>"
)
VERSION = r"^[0-9A-Za-z][0-9A-Za-z.+_-]{0,63}$"


def documents(spark: SparkSession, root: str, folders: DataFrame) -> DataFrame:
    """A row per folder of ``folders(folder)``: its document, and ``state``.

    ``labels.json`` (``labelled``) is preferred to ``run.json`` (``failed``);
    a folder with neither was ``killed``.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    own = found.select(F.element_at(F.split("path", "/"), -2).alias("folder"), name.alias("name"), F.decode("content", "utf-8").alias("text")).where("name in ('labels.json', 'run.json')")
    best = own.groupBy("folder").agg(F.min_by(F.struct("name", "text"), "name").alias("best"))
    state = F.when(F.col("best").isNull(), "killed").when(F.col("best.name") == "labels.json", "labelled").otherwise("failed")
    return folders.join(best, "folder", "left").select("folder", state.alias("state"), F.from_json("best.text", RUN, {"mode": "FAILFAST"}).alias("doc")).select("folder", "state", "doc.*")


def entries(runs: DataFrame) -> DataFrame:
    """Source entries of labelled runs, flat: what the triage reports count."""
    each = runs.where("state = 'labelled'").select(F.col("folder").alias("run_id"), F.explode("labels").alias("l")).select("run_id", F.explode("l.sources").alias("s"))
    return each.select("run_id", "s.*")


def toolchain(texts: DataFrame, *tools: str) -> DataFrame:
    """``value`` (a JSON object of versions) -> a row per tool: version, and a warning where it can't be used."""
    versions = F.from_json("value", "map<string, string>")
    rows = texts.select(versions.alias("v")).select(F.explode(F.array(*[F.struct(F.lit(t).alias("tool"), F.try_element_at("v", F.lit(t)).alias("raw"), F.col("v").isNotNull().alias("readable")) for t in tools])).alias("t")).select("t.*")
    good = F.coalesce(F.col("raw").rlike(VERSION), F.lit(False))
    warning = F.when(~F.col("readable"), "the manifest can't be read").when(F.col("raw").isNull(), F.concat(F.lit("no version of "), "tool")).when(~good, F.concat(F.lit("unusable version of "), "tool"))
    return rows.select("tool", F.when(good, F.col("raw")).alias("version"), warning.alias("warning"))


def verified(files: DataFrame, expected: str) -> DataFrame:
    """``files(path, content)`` unchanged; raises if their content address isn't ``expected``."""
    found = rules.content_id(files).first()[0]
    if found != expected:
        raise ValueError(f"snapshot {expected} has the content of {found}")
    return files


def valid_marker(x: Column) -> Column:
    """Whether a policy's marker is one pictograph (joiners aside)."""
    return F.coalesce(x.rlike(r"^[\p{So}ℹ][\p{Mn}\p{Cf}]*$"), F.lit(False))


def valid_classtype(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^[A-Za-z0-9._-]+$"), F.lit(False))
