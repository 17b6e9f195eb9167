"""A device's threat log as tier-1 detections, beside those of tier 2, and what the device lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import device
from . import labels

SOURCE, TIER = "device/threat-log", 1
#: Identity of a detection, and the order in which they are listed.
KEY = ["sid", "src_ip", "src_port", "dst_ip", "dst_port", "proto"]
ORDER = ["ts_us", "sid", "src_ip", "src_port"]
#: Columns of a detection of either tier.
COLUMNS = ["source", "tier", "sid", "rev", "classtype", "app_proto", "threat", "ts_us", "src_ip", "src_port", "dst_ip", "dst_port", "proto", "direction"]
#: The device's counters of threat logs that it wrote.
COUNTERS = ("vulnerability", "spyware", "anti-virus", "wildfire anti-virus", "spyware-dns")


def _read(entries: DataFrame) -> DataFrame:
    sid = device.threat_id(F.col("threatid"), F.col("tid"))
    name = device.threat_name(F.coalesce("threatid", F.lit("")))
    why = F.when(~device.admits(F.col("subtype")), F.concat(F.lit("subtype "), F.coalesce(F.nullif(F.trim("subtype"), F.lit("")), F.lit("none")))).when(sid.isNull(), "no threat id")
    return entries.withColumns({"__sid": sid, "__name": name, "__why": why})


def detections(entries: DataFrame, source: str = SOURCE) -> DataFrame:
    """Threat-log ``entries`` that may label, with the ruleset that the device had; times are the device's clock."""
    empty = lambda c: F.nullif(F.trim(c), F.lit(""))
    return _read(entries).where("__why is null").select(
        F.lit(source).alias("source"), F.lit(TIER).alias("tier"), F.col("__sid").alias("sid"), F.lit(0).cast("bigint").alias("rev"), empty("thr_category").alias("classtype"), empty("app").alias("app_proto"), F.col("__name").alias("threat"),
        device.received_us(F.coalesce("receive_time", F.lit(""))).alias("ts_us"), F.coalesce(F.trim("src"), F.lit("")).alias("src_ip"), device.port(F.col("sport")).alias("src_port"), F.coalesce(F.trim("dst"), F.lit("")).alias("dst_ip"), device.port(F.col("dport")).alias("dst_port"),
        F.coalesce(device.proto(F.col("proto")), F.lit("")).alias("proto"), device.direction(F.coalesce("direction", F.lit(""))).alias("direction"), device.ruleset(F.coalesce("contentver", F.lit("")), F.coalesce("config_ver", F.lit(""))).alias("ruleset"),
    )


def declined(entries: DataFrame) -> DataFrame:
    """``threat, why``: a row for each entry that may not label."""
    return _read(entries).where("__why is not null").select(F.col("__name").alias("threat"), F.col("__why").alias("why"))


def deduplicated(dets: DataFrame) -> DataFrame:
    """The earliest detection of each key, with ``firings``, in the order of ``ORDER``.

    Entries at the same time are told apart by the columns that aren't in the
    key, so that the one kept doesn't depend on the order of the rows.
    """
    rest = [c for c in dets.columns if c not in {*KEY, "ts_us"}]
    return labels.first_per_key(dets, KEY, ["ts_us", *sorted(rest)]).orderBy(*ORDER, "dst_ip", "dst_port", "proto")


def with_first_ruleset(dets: DataFrame, key: list[str] = KEY, order: str = "did") -> DataFrame:
    """``dets`` with ``first_ruleset``: the ruleset of the first entry of their key, which is the one that a label cites."""
    first = dets.groupBy(*key).agg(F.min_by("ruleset", order).alias("first_ruleset"))
    return dets.join(first, key, "left")


def union(one: DataFrame, two: DataFrame) -> DataFrame:
    """Detections of both tiers with one schema, which are placed together."""
    types = {"sid": "bigint", "rev": "bigint", "ts_us": "bigint", "src_port": "int", "dst_port": "int", "tier": "int"}
    same = lambda d: d.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in COLUMNS])
    return same(one).unionByName(same(two))


def written(before: Column, after: Column) -> Column:
    """Threat logs that the device wrote between two maps of its counters; a counter that was reset counts for nothing."""
    of = lambda m, n: F.coalesce(F.try_element_at(m, F.lit(n)), F.lit(0))
    return sum((device.counter_delta(of(before, n), of(after, n)) for n in COUNTERS), F.lit(0))


def loss(retrieved: Column, wrote: Column) -> Column:
    """What is missing if the device wrote more than was retrieved, else null; fewer is no loss."""
    return F.when(wrote > retrieved, F.format_string("%d written, %d retrieved: %d missing", wrote.cast("bigint"), retrieved.cast("bigint"), (wrote - retrieved).cast("bigint")))
