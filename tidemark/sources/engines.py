"""Logs of flow and detection engines: JSON lines, TSV, and what they say about themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import device
from ..functions.net import compressed
from ..operators.store import micros

#: Keys that the engines write; a line without a required one is a failure, not a gap.
CONN = "ts double, uid string, `id.orig_h` string, `id.orig_p` int, `id.resp_h` string, `id.resp_p` int, proto string, duration double"
SSL = "uid string, ja4 string, ja4s string, server_name string"
EVE = (
    "event_type string, timestamp string, src_ip string, src_port int, dest_ip string, dest_port int, icmp_type int, icmp_code int, proto string, app_proto string, direction string, flow_id bigint, "
    "alert struct<signature_id: bigint, rev: bigint, signature: string, metadata: map<string, array<string>>>, stats struct<detect: struct<engines: array<struct<rules_loaded: bigint, rules_failed: bigint, rules_skipped: bigint>>>>"
)
STRICT = {"mode": "FAILFAST"}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``pos, value``: the lines of text files; ``pos`` grows along a file. Compressed files are read as well."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), "value")


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    return raw.where(F.trim("value") != "").select("pos", F.from_json("value", schema, STRICT).alias("j")).select("pos", "j.*")


def _required(df: DataFrame, *names: str) -> DataFrame:
    """Raises on a row that lacks one of ``names``; the check is part of the first of them, so it isn't pruned."""
    missing = F.array_compact(F.array(*[F.when(F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]))
    fault = F.raise_error(F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    return df.withColumn(names[0], F.when(F.size(missing) > 0, fault.cast(df.schema[names[0]].dataType)).otherwise(F.col(f"`{names[0]}`")))


def flows(conn: DataFrame, ssl: DataFrame | None = None) -> DataFrame:
    """Flows from connection and TLS log lines (``pos, value``); a uid that occurs twice is a failure."""
    c = _required(_parsed(conn, CONN), "uid", "ts", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto")
    rows = c.groupBy("uid").agg(F.count("*").alias("n"), *[F.first(f"`{k}`").alias(k.replace(".", "_")) for k in ("ts", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "duration")])
    uid = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate uid "), "uid")).cast("string")).otherwise(F.col("uid"))
    out = rows.select(
        uid.alias("uid"), F.col("id_orig_h").alias("src_ip"), F.col("id_orig_p").alias("src_port"), F.col("id_resp_h").alias("dst_ip"), F.col("id_resp_p").alias("dst_port"), F.lower("proto").alias("proto"),
        micros(F.col("ts")).alias("ts_first_us"), micros(F.col("ts") + F.coalesce("duration", F.lit(0.0))).alias("ts_last_us"),
    )
    if ssl is None:
        return out
    s = _parsed(ssl, SSL)
    first = s.groupBy("uid").agg(*[F.min_by(k, F.when(F.col(k).isNotNull(), F.col("pos"))).alias(k) for k in ("ja4", "ja4s", "server_name")])
    return out.join(first, "uid", "left")


def eve(raw: DataFrame) -> DataFrame:
    return _parsed(raw, EVE)


def epoch(stamp: Column) -> Column:
    """A timestamp with an offset, in microseconds; without an offset it is an error."""
    return F.when(stamp.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.unix_micros(F.to_timestamp(stamp))).otherwise(F.raise_error(F.concat(F.lit("no offset: "), stamp)).cast("bigint"))


def metadata(m: Column) -> Column:
    """``key value`` strings, sorted; each value of a list is one."""
    pairs = F.transform(F.map_entries(m), lambda e: F.transform(e["value"], lambda v: F.concat_ws(" ", e["key"], v)))
    return F.coalesce(F.array_sort(F.flatten(pairs)), F.array().cast("array<string>"))


def unclaimed(index: DataFrame) -> DataFrame:
    """``index(sid, source, ..)`` with a row per sid; a sid that two sources claim is a failure."""
    rest = [c for c in index.columns if c not in ("sid", "source")]
    by = index.groupBy("sid").agg(F.min("source").alias("source"), F.max("source").alias("__other"), *[F.min_by(c, "source").alias(c) for c in rest])
    fault = F.raise_error(F.concat(F.lit("sid "), F.col("sid").cast("string"), F.lit(" is claimed by "), F.col("source"), F.lit(" and "), F.col("__other")))
    return by.withColumn("source", F.when(F.col("source") != F.col("__other"), fault.cast("string")).otherwise(F.col("source"))).select(*index.columns)


def detections(events: DataFrame, index: DataFrame, classtypes: DataFrame) -> DataFrame:
    """Alerts as tier-2 detections; a sid that the index doesn't have, or has of two sources, is a failure.

    ``index(sid, source, source_class)``: alerts of identify sources are left
    out (see :func:`alert_counts`).  ``classtypes(sid, classtype)``: the first
    in text order of a sid that has several.  Alerts without ports carry ICMP
    type and code in their place.
    """
    a = events.where("event_type = 'alert'")
    has = F.col("src_port").isNotNull() | F.col("dest_port").isNotNull()
    own = a.select(
        "pos", F.col("alert.signature_id").alias("sid"), F.coalesce("alert.rev", F.lit(0)).alias("rev"), F.col("alert.signature").alias("threat"), epoch(F.col("timestamp")).alias("ts_us"), compressed("src_ip").alias("src_ip"), compressed("dest_ip").alias("dst_ip"),
        F.when(has, F.coalesce("src_port", F.lit(0))).otherwise(F.coalesce("icmp_type", F.lit(0))).alias("src_port"), F.when(has, F.coalesce("dest_port", F.lit(0))).otherwise(F.coalesce("icmp_code", F.lit(0))).alias("dst_port"),
        F.coalesce(device.proto(F.col("proto")), F.lit("")).alias("proto"), "app_proto", F.when(F.col("direction").isin("to_server", "to_client"), F.col("direction")).otherwise("unknown").alias("direction"), metadata(F.col("alert.metadata")).alias("metadata"),
    )
    joined = own.join(unclaimed(index), "sid", "left").join(classtypes.groupBy("sid").agg(F.min("classtype").alias("classtype")), "sid", "left")
    source = F.when(F.col("source").isNull(), F.raise_error(F.concat(F.lit("no source has sid "), F.col("sid").cast("string"))).cast("string")).otherwise(F.col("source"))
    return joined.withColumns({"source": source, "tier": F.lit(2)}).where(~F.col("source_class").eqNullSafe("identify")).drop("source_class")


def alert_counts(events: DataFrame, index: DataFrame) -> DataFrame:
    """One row: all alerts, those of identify sources, and other events."""
    a = events.withColumn("sid", F.col("alert.signature_id")).join(unclaimed(index), "sid", "left")
    alert = F.col("event_type") == "alert"
    return a.agg(F.count_if(alert).alias("alerts_total"), F.count_if(alert & (F.col("source_class") == "identify")).alias("identify_suppressed"), F.count_if(~alert).alias("other_events"))


def rules_loaded(events: DataFrame) -> DataFrame:
    """One row: (loaded, failed, skipped) of the last statistics that report engines; nulls if none does."""
    best = F.array_max(F.transform("stats.detect.engines", lambda e: F.struct(e["rules_loaded"].alias("loaded"), e["rules_failed"].alias("failed"), e["rules_skipped"].alias("skipped"))))
    s = events.where("event_type = 'stats' and size(stats.detect.engines) > 0").select("pos", best.alias("b"))
    return s.agg(F.max_by("b", "pos").alias("b")).select("b.*")


def rules_loaded_log(raw: DataFrame) -> DataFrame:
    """The same from an engine's log text: the last line that says so."""
    pattern = r"(\d+) rules successfully loaded, (\d+) rules failed, (\d+) rules skipped"
    found = raw.where(F.col("value").rlike(pattern))
    return found.agg(F.max_by("value", "pos").alias("v")).select(*[F.nullif(F.regexp_extract("v", pattern, i + 1), F.lit("")).try_cast("bigint").alias(n) for i, n in enumerate(("loaded", "failed", "skipped"))])


def tsv_records(raw: DataFrame) -> DataFrame:
    """Lines of a TSV log without headers and blank lines."""
    return raw.where((F.trim("value") != "") & ~F.startswith("value", F.lit("#")))


def without_first_column(raw: DataFrame) -> DataFrame:
    return tsv_records(raw).withColumn("value", F.regexp_replace("value", r"^[^\t]*\t", ""))


def ruleset_check(loaded: Column, admitted: Column) -> Column:
    """Null if all rules were loaded, else what is wrong; no count and no rule are failures."""
    return F.when(loaded.isNull(), "failure: no count").when(loaded == 0, "failure: no rule loaded").when(loaded < admitted, F.format_string("warning: %d of %d rules loaded (%.1f%%)", loaded.cast("bigint"), admitted.cast("bigint"), 100.0 * loaded / admitted))
