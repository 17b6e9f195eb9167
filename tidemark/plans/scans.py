"""Queries through the sources: engine logs, XML and index documents made from the derived tables and read back."""

from __future__ import annotations

import gzip
import struct

import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import constraints, documents, rules
from ..sources import captures, engines, feeds, scratch
from .fixtures import duck, views
from .ruleset import ADMITTED, JUDGED


def _lines(df, *columns):
    return df.select(F.monotonically_increasing_id().alias("pos"), F.to_json(F.struct(*columns)).alias("value"))


def conn_scan(spark, sf_dir):
    f = views(spark, sf_dir)["flows"]
    seconds = (F.col("ts_first_us") / F.lit(1_000_000)).cast("double")
    length = F.when(F.expr("o_orderkey % 40 <> 0"), ((F.col("ts_last_us") - F.col("ts_first_us")) / F.lit(1_000_000)).cast("double"))
    raw = _lines(f, seconds.alias("ts"), "uid", F.col("src_ip").alias("id.orig_h"), F.col("src_port").alias("id.orig_p"), F.col("dst_ip").alias("id.resp_h"), F.col("dst_port").alias("id.resp_p"), F.upper("proto").alias("proto"), length.alias("duration"))
    ssl = f.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("pos"), F.to_json(F.struct("uid", F.concat(F.lit("name"), (F.col("o_orderkey") % 9).cast("string")).alias("server_name"))).alias("value"))
    return engines.flows(raw, ssl).select("uid", "proto", "src_ip", "src_port", "dst_ip", "dst_port", "ts_first_us", "ts_last_us", "server_name")


def _eve(v):
    d = v["dets"].where("tier = 2")
    return _lines(
        d, F.when(F.col("sid") % 31 == 0, "flow").otherwise("alert").alias("event_type"), F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXX").alias("timestamp"), "src_ip", F.when(F.col("proto") != "icmp", F.col("src_port")).alias("src_port"), F.col("dst_ip").alias("dest_ip"),
        F.when(F.col("proto") != "icmp", F.col("dst_port")).alias("dest_port"), F.when(F.col("proto") == "icmp", F.col("src_port")).alias("icmp_type"), F.when(F.col("proto") == "icmp", F.col("dst_port")).alias("icmp_code"),
        F.when(F.col("proto") == "icmp", "IPv6-ICMP").otherwise(F.upper("proto")).alias("proto"), "direction", F.col("did").alias("flow_id"),
        F.struct(F.col("sid").alias("signature_id"), "rev", F.col("threat").alias("signature"), F.create_map(F.lit("tag"), F.array(F.lit("b"), F.lit("a")), F.lit("age"), F.array(F.lit("1"))).alias("metadata")).alias("alert"),
    )


def _index(v):
    return v["dets"].groupBy("sid").agg(F.min("source_id").alias("source_id")).join(F.broadcast(v["terms"]), "source_id").select("sid", "source", "source_class")


def eve_scan(spark, sf_dir):
    v = views(spark, sf_dir)
    classtypes = v["rule_lines"].select(rules.sid(F.col("text")).alias("sid"), rules.classtype(F.col("text")).alias("classtype"))
    d = engines.detections(engines.eve(_eve(v)), _index(v), classtypes)
    return d.groupBy("source", "proto", "direction", F.array_join("metadata", "|").alias("metadata")).agg(F.count("*").alias("detections"), F.sum("src_port").alias("ports"), F.max("ts_us").alias("last_us"), F.count_distinct("classtype").alias("classtypes"))


def alert_counts(spark, sf_dir):
    v = views(spark, sf_dir)
    return engines.alert_counts(engines.eve(_eve(v)), _index(v))


def sid_index_scan(spark, sf_dir):
    j = rules.judge(views(spark, sf_dir)["rule_lines"])
    index = rules.sid_index(j)
    doc = index.select(F.to_json(F.struct(F.lit(3).alias("schema"), F.create_map("source", "sids").alias("sources"), F.filter("sids", lambda x: x % 4 == 0).alias("address_indicator"))).alias("value"))
    return feeds.sid_index(doc).groupBy("source", "address_indicator").agg(F.count("*").alias("sids"))


def loss_flags(spark, sf_dir):
    e = F.expr
    r = views(spark, sf_dir)["all_runs"].select(
        "run_id", e("CASE WHEN event_id % 9 > 0 THEN 'complete' END AS input_status"), e("CASE WHEN event_id % 5 = 0 THEN 100 END AS truncated_at"), e("event_id % 2 AS discarded_packets"), e("CASE WHEN event_id % 4 > 0 THEN event_id % 3 END AS no_flow_match"),
        e("CASE WHEN event_id % 4 > 0 THEN event_id % 2 END AS ambiguous_flow_match"), e("CASE WHEN event_id % 4 > 0 THEN 0 END AS unsupported_transport"), e("CASE WHEN event_id % 11 > 0 THEN 1 END AS tool_failures"), e("CASE WHEN event_id % 7 > 0 THEN event_id % 7 > 1 END AS snapshot_resolved"),
        e("event_id % 2 AS identify_suppressed"), e("CASE WHEN event_id % 6 > 2 THEN event_id % 2 END AS rules_failed"), e("CASE WHEN event_id % 6 > 4 THEN 0 END AS rules_skipped"), e("CASE event_id % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'probe-failed' END AS ja4_status"),
    )
    return r.select("run_id", *documents.loss_flags())


def enumeration_violations(spark, sf_dir):
    d = views(spark, sf_dir)["dets"].withColumn("direction", F.expr("CASE WHEN sid % 500 = 0 THEN 'sideways' ELSE direction END"))
    return constraints.enumerations(d, "did")


def notice_lines(spark, sf_dir):
    v = views(spark, sf_dir)
    return documents.notice(v["dets"].select("source_id").distinct().join(F.broadcast(v["terms"]), "source_id").where("source_class <> 'identify'").select("source", "licence"))


#: Flows a capture file stands for, and what its number makes of it: a pcap, a pcapng, a packed pcap, a pcap that is cut off.
PER_FILE = 10_000


def _capture_bytes(block: int, packets: list[tuple[int, int, int]]) -> bytes:
    """A capture of (microseconds, bytes, interface) packets."""
    if block % 4 == 1:
        frame = lambda kind, body: struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)
        out = [frame(captures.SECTION, struct.pack("<IHHq", captures.ORDER, 1, 0, -1)), frame(captures.INTERFACE, struct.pack("<HHI", 1, 0, 65535)), frame(captures.INTERFACE, struct.pack("<HHI", 101, 0, 200))]
        return b"".join(out + [frame(captures.PACKET, struct.pack("<IIIII", i, us >> 32, us & 0xFFFFFFFF, n, n) + bytes(n + -n % 4)) for us, n, i in packets])
    out = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1) + b"".join(struct.pack("<IIII", us // 1_000_000, us % 1_000_000, n, n) + bytes(n) for us, n, _ in packets)
    return gzip.compress(out) if block % 4 == 2 else out[: len(out) - (block % 4 == 3)]


def capture_facts(spark, sf_dir):
    """Captures written from the flows, a packet each, and read back: facts per file."""
    f = views(spark, sf_dir)["flows"]
    packets = f.select("capture", F.expr(f"o_orderkey div {PER_FILE}").alias("block"), "o_orderkey", F.col("ts_first_us").alias("us"), F.expr("CAST(40 + o_orderkey % 100 AS int)").alias("bytes"), F.expr("CAST(o_orderkey % 10 = 0 AS int)").alias("interface"))
    uri = scratch.folder(spark, "captures")

    def write(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["o_orderkey"])
        name = f"{rows[0]['capture']}_{rows[0]['block']}"
        scratch.put(uri, name, _capture_bytes(rows[0]["block"], [(r["us"], r["bytes"], r["interface"]) for r in rows]))
        return pa.table({"name": [name]})

    written = packets.groupBy("capture", "block").applyInArrow(write, "name string").count()
    name = F.element_at(F.split("path", "/"), -1)
    facts = captures.facts(captures.read(spark, uri)) if written else captures.facts(spark.createDataFrame([], captures.ROW))
    return facts.select(
        name.alias("name"), "container", F.col("packets").cast("bigint").alias("packets"), "link_type_name", F.array_join(F.transform("snaplens", lambda x: x.cast("string")), ",").alias("snaplens"), "first_us", "last_us",
        F.col("truncated_at").isNotNull().alias("cut"), F.col("discarded_packets").cast("bigint").alias("discarded"), "input_status", "fault",
    )


_CAPTURES = f"""p AS (SELECT capture, o_orderkey // {PER_FILE} AS block, o_orderkey AS k, ts_first_us AS us, o_orderkey % 10 = 0 AS other FROM flows),
whole AS (SELECT *, row_number() OVER (PARTITION BY capture, block ORDER BY k DESC) AS last FROM p),
held AS (SELECT *, block % 4 = 1 AND other AS raw FROM whole WHERE block % 4 <> 3 OR last > 1),
f AS (SELECT capture, block, count(*) AS packets, count(*) FILTER (raw) AS raws, arg_min(us, k) AS first_us, arg_max(us, k) AS last_us FROM held GROUP BY ALL),
g AS (SELECT DISTINCT capture, block FROM p)
SELECT concat(g.capture, '_', g.block) AS name, CASE g.block % 4 WHEN 1 THEN 'pcapng' WHEN 2 THEN 'pcap.gz' ELSE 'pcap' END AS container, coalesce(packets, 0) AS packets,
 CASE WHEN packets IS NULL THEN NULL WHEN raws > packets - raws THEN 'RAW' ELSE 'ETHERNET' END AS link_type_name, CASE WHEN packets IS NULL THEN NULL WHEN raws > packets - raws THEN '200' ELSE '65535' END AS snaplens, first_us, last_us,
 g.block % 4 = 3 AS cut, coalesce(least(raws, packets - raws), 0) AS discarded, CASE WHEN packets IS NULL THEN NULL WHEN g.block % 4 = 3 OR least(raws, packets - raws) > 0 THEN 'partial' ELSE 'complete' END AS input_status, CASE WHEN packets IS NULL THEN 'no packet' END AS fault
FROM g LEFT JOIN f USING (capture, block)"""
_T2 = "x AS (SELECT * FROM dets WHERE tier = 2), ix AS (SELECT sid, min(source_id) AS source_id FROM dets GROUP BY sid), it AS (SELECT ix.sid, t.source, t.source_class FROM ix JOIN terms t USING (source_id))"
QUERIES = {
    "s10_s11_conn_scan": (conn_scan, f"{duck('flows')} SELECT uid, proto, src_ip, src_port, dst_ip, dst_port, ts_first_us, ts_last_us, CASE WHEN o_orderkey % 3 = 0 THEN concat('name', o_orderkey % 9) END AS server_name FROM flows"),
    "s12_p01_eve_scan": (
        eve_scan,
        f"""{duck('dets', 'terms', 'rule_lines')}, {_T2}, c AS (SELECT CAST(regexp_extract(text, 'sid:(\\d+)', 1) AS bigint) AS sid, regexp_extract(text, 'classtype:([a-z-]+)', 1) AS classtype FROM rule_lines)
SELECT it.source, x.proto, direction, 'age 1|tag a|tag b' AS metadata, count(*) AS detections, sum(src_port) AS ports, max(ts_us) AS last_us, count(DISTINCT classtype) AS classtypes
FROM x JOIN it USING (sid) LEFT JOIN c USING (sid) WHERE x.sid % 31 <> 0 AND it.source_class <> 'identify' GROUP BY 1, 2, 3""",
    ),
    "s12_alert_counts": (alert_counts, f"{duck('dets', 'terms')}, {_T2} SELECT count(*) FILTER (x.sid % 31 <> 0) AS alerts_total, count(*) FILTER (x.sid % 31 <> 0 AND source_class = 'identify') AS identify_suppressed, count(*) FILTER (x.sid % 31 = 0) AS other_events FROM x JOIN it USING (sid)"),
    "s21_s22_sid_index_scan": (sid_index_scan, f"{duck('rule_lines')}, {JUDGED}, x AS (SELECT DISTINCT source, CAST(sid_text AS bigint) AS sid FROM judged WHERE {ADMITTED}) SELECT source, sid % 4 = 0 AS address_indicator, count(*) AS sids FROM x GROUP BY 1, 2"),
    "a13_loss_flags": (
        loss_flags,
        f"""{duck('all_runs')} SELECT run_id, CASE WHEN event_id % 9 > 0 THEN event_id % 5 = 0 END AS input_truncated, CASE WHEN event_id % 9 > 0 THEN event_id % 2 > 0 END AS multi_datalink_discard, CASE WHEN event_id % 4 > 0 THEN event_id % 3 > 0 END AS detection_uncorrelatable,
 CASE WHEN event_id % 4 > 0 THEN event_id % 2 > 0 END AS ambiguous_flow_match, CASE WHEN event_id % 4 > 0 THEN false END AS unsupported_transport, event_id % 11 > 0 AS tool_failure, CASE WHEN event_id % 7 > 0 THEN event_id % 7 <= 1 END AS snapshot_missing, event_id % 2 > 0 AS identify_alert_suppressed,
 CASE WHEN event_id % 6 > 2 THEN event_id % 2 > 0 END AS rules_failed_or_skipped, CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN true END AS ja4_unavailable FROM all_runs""",
    ),
    "enumeration_violations": (enumeration_violations, f"{duck('dets')} SELECT did, 'direction is unknown' AS rule FROM dets WHERE sid % 500 = 0"),
    "s02_s09_capture_facts": (capture_facts, f"{duck('flows')}, {_CAPTURES}"),
    "k03_notice_lines": (notice_lines, f"{duck('dets', 'terms')} SELECT DISTINCT source, concat(source, ' — ', licence) AS line FROM dets JOIN terms USING (source_id) WHERE source_class <> 'identify'"),
}
