"""One label per flow from the detections placed on it, and what is wrong with a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNNAMED = "unnamed"
#: Label names and the tiers that may carry them.
KINDS = {"verdict": (1, 2), "threat-name": (1,)}


def basis(source_class: Column, address_indicator: Column) -> Column:
    """``direct`` only for a feed whose rules match traffic and a rule known not to be an address list."""
    feed = F.when(source_class.isin("signature", "ioc-dest"), "direct").otherwise("indicator-reference")
    return F.when((feed == "direct") & address_indicator.eqNullSafe(F.lit(False)), "direct").otherwise("indicator-reference")


def entries(placed: DataFrame, terms: DataFrame, indicators: DataFrame) -> DataFrame:
    """Placed detections with the terms of their source; sources that may not label are left out.

    A source without terms is a failure: its label would have an invented
    origin.  ``indicators(sid, address_indicator)``: a sid that isn't there is
    unclassified, not false.
    """
    own = placed.where("uid is not null").join(terms, "source_id", "left").join(indicators, "sid", "left")
    fault = F.raise_error(F.concat(F.lit("no terms of source "), F.coalesce(F.col("source_id").cast("string"), F.lit("null"))))
    known = own.withColumn("source_class", F.when(F.col("source_class").isNull(), fault.cast("string")).otherwise(F.col("source_class")))
    return known.where("source_class <> 'identify'").withColumn("label_basis", basis(F.col("source_class"), F.col("address_indicator")))


def consolidate(rows: DataFrame) -> DataFrame:
    """A row per flow: best tier, verdict sids, threat name, and all its source entries in order.

    Entries are a bag: a rule that fired twice stays twice.  The threat name is
    that of the earliest inline detection with a name; times that couldn't be
    read (0) come last, ties go to the lower sid, then to the name.
    """
    named = (F.col("tier").isin(*KINDS["threat-name"])) & (F.col("threat") != UNNAMED)
    entry = F.struct("tier", "source", "sid", "rev", "direction", "threat", "licence", "admission_basis", "label_basis")
    order = F.struct(F.col("alert_us") == 0, "alert_us", "sid", "threat")
    return rows.groupBy("uid").agg(
        F.min("tier").alias("best_tier"),
        F.sort_array(F.collect_list(entry)).alias("sources"),
        F.array_sort(F.collect_set("sid")).alias("verdict_sids"),
        F.min_by(F.struct("threat", "tier", "sid"), F.when(named, order)).alias("inline"),
        F.max(named.cast("int")).alias("has_name"),
    ).withColumn("inline", F.when(F.col("has_name") == 1, F.col("inline"))).drop("has_name")


def label_entries(labels: DataFrame) -> DataFrame:
    """``consolidate`` with its ``labels`` array, sorted by name."""
    verdict = F.struct(F.lit("verdict").alias("name"), F.lit("malicious").alias("value"), F.col("best_tier").alias("tier"), F.col("verdict_sids").alias("sids"))
    name = F.struct(F.lit("threat-name").alias("name"), F.col("inline.threat").alias("value"), F.col("inline.tier").alias("tier"), F.array("inline.sid").alias("sids"))
    return labels.withColumn("labels", F.when(F.col("inline").isNull(), F.array(verdict)).otherwise(F.array(name, verdict)))


def kinds(placed: DataFrame) -> DataFrame:
    """``uid, names``: the label names that each flow's placed detections give it, in order."""
    named = F.count_if(F.col("tier").isin(*KINDS["threat-name"]) & (F.col("threat") != UNNAMED)) > 0
    return placed.where("uid is not null").groupBy("uid").agg(F.array_compact(F.array(F.when(named, F.lit("threat-name")), F.lit("verdict"))).alias("names"))


def selected(kinds: DataFrame, *asked: str) -> DataFrame:
    """``uid`` of flows that carry every name that is asked for."""
    want = F.array(*[F.lit(n) for n in asked])
    return kinds.where(F.size(F.array_intersect("names", want)) == F.size(want)).select("uid")


def suppressed(dets: DataFrame, terms: DataFrame) -> DataFrame:
    """``tier, suppressed, kept``: detections of sources that only identify traffic and may never label, beside the others."""
    identify = F.col("source_class") == "identify"
    return dets.join(terms, "source_id").groupBy("tier").agg(F.count_if(identify).alias("suppressed"), F.count_if(~identify).alias("kept"))


def violations(labels: DataFrame) -> DataFrame:
    """``uid, rule``: labels that break an invariant; none are expected."""
    names = F.transform("labels", lambda x: x["name"])
    tiers = F.transform("sources", lambda x: x["tier"])
    sids = F.transform("sources", lambda x: x["sid"])
    verdicts = F.filter("labels", lambda x: x["name"] == "verdict")
    checks = {
        "no sources": F.size("sources") == 0,
        "best tier is not the least": ~F.col("best_tier").eqNullSafe(F.array_min(tiers)),
        "not exactly one verdict": F.size(verdicts) != 1,
        "names repeat or are not sorted": (F.size(F.array_distinct(names)) != F.size(names)) | (F.array_sort(names) != names),
        "verdict tier is not the best": F.get(verdicts, F.lit(0))["tier"] != F.col("best_tier"),
        "unknown name": F.exists(names, lambda x: ~x.isin(*KINDS)),
        "tier not permitted": F.exists("labels", lambda x: (x["name"] == "threat-name") & (x["tier"] != 1)),
        "empty value": F.exists("labels", lambda x: F.coalesce(x["value"], F.lit("")) == ""),
        "sids empty, unsorted or repeated": F.exists("labels", lambda x: (F.size(x["sids"]) == 0) | (F.array_sort(F.array_distinct(x["sids"])) != x["sids"])),
        "sids without a source": F.exists("labels", lambda x: F.size(F.array_except(x["sids"], sids)) > 0),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))
    return labels.select("uid", F.explode(broken).alias("rule"))


def first_per_key(dets: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keeps the first row of each key in ``order``, with the number of rows it stands for."""
    rest = [c for c in dets.columns if c not in key]
    kept = dets.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"), F.count("*").alias("firings"))
    return kept.select(*[F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in dets.columns], "firings")
