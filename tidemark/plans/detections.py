"""Queries over flows and detections: placement, labels, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlate, labels, replay, tier1
from .fixtures import duck, views

#: DuckDB's own placement: both orientations as keys, one or two probes, then the truth table.
_PAIRS4 = ", ".join(f"({a}, {b})" for a, b in correlate.ICMP4.items())
PLACED = f"""pair4(a, b) AS (VALUES {_PAIRS4}),
keys AS (
  SELECT uid, proto, src_ip, src_port, dst_ip, dst_port, ts_first_us, ts_last_us FROM flows
  UNION SELECT uid, proto, dst_ip, dst_port, src_ip, src_port, ts_first_us, ts_last_us FROM flows
), probe AS (
  SELECT did, ts_us, proto, src_ip, src_port, dst_ip, dst_port FROM dets
  UNION SELECT did, ts_us, proto, src_ip, src_port, dst_ip, b FROM dets JOIN pair4 ON src_port = a WHERE proto = 'icmp' AND dst_port <> b
), cand AS (
  SELECT DISTINCT p.did, k.uid, p.ts_us BETWEEN k.ts_first_us AND k.ts_last_us AS inside
  FROM probe p JOIN keys k USING (proto, src_ip, src_port, dst_ip, dst_port)
), agg AS (
  SELECT did, count(*) AS n, count(*) FILTER (inside) AS k, min(uid) AS a, min(uid) FILTER (inside) AS b FROM cand GROUP BY did
), placed AS (
  SELECT d.*, CASE WHEN d.proto <> '' AND lower(d.proto) NOT IN ('tcp', 'udp', 'icmp') THEN 'unsupported_transport' WHEN n IS NULL THEN 'no_flow_match' WHEN n > 1 AND k <> 1 THEN 'ambiguous_flow_match' END AS reason,
    CASE WHEN d.proto <> '' AND lower(d.proto) NOT IN ('tcp', 'udp', 'icmp') THEN NULL WHEN n = 1 THEN a WHEN k = 1 THEN b END AS uid,
    CASE WHEN d.proto <> '' AND lower(d.proto) NOT IN ('tcp', 'udp', 'icmp') THEN NULL WHEN n = 1 THEN 'lone' WHEN k = 1 THEN 'clock' END AS how
  FROM dets d LEFT JOIN agg USING (did)
)"""
INDICATOR = "sid % 4 = 0"
ENTRIES = f"""entries AS (
  SELECT p.*, t.source, t.licence, t.admission_basis, t.source_class,
    CASE WHEN t.source_class IN ('signature', 'ioc-dest') AND NOT ({INDICATOR}) AND sid % 5 <> 0 THEN 'direct' ELSE 'indicator-reference' END AS label_basis
  FROM placed p JOIN terms t USING (source_id) WHERE p.uid IS NOT NULL AND t.source_class <> 'identify'
)"""
_NAME = "CASE WHEN tier = 1 AND threat <> 'unnamed' THEN {} END"


def placed(v):
    return correlate.place(v["dets"], v["flows"])


def entries(v):
    # Sids that are multiples of five are unclassified: the flag is unknown, not false.
    sids = v["dets"].select("sid").distinct().where("sid % 5 <> 0").select("sid", F.expr(INDICATOR).alias("address_indicator"))
    return labels.entries(placed(v), v["terms"], sids)


def correlate_placement(spark, sf_dir):
    return placed(views(spark, sf_dir)).select("did", "uid", "reason", "how")


def placement_counts(spark, sf_dir):
    out = placed(views(spark, sf_dir)).groupBy(F.coalesce("reason", "how").alias("placement"))
    return out.agg(F.count("*").alias("detections"))


def bidirectional_candidates(spark, sf_dir):
    v = views(spark, sf_dir)
    return correlate.candidate_counts(v["dets"], v["flows"])


def label_consolidation(spark, sf_dir):
    out = labels.consolidate(entries(views(spark, sf_dir)))
    return out.select(
        "uid", "best_tier", F.size("sources").cast("long").alias("sources"), F.md5(F.array_join(F.transform("sources", lambda x: F.concat_ws("|", x["tier"].cast("string"), x["source"], x["sid"].cast("string"), x["rev"].cast("string"), x["direction"], x["threat"], x["licence"], x["admission_basis"], x["label_basis"])), "\n").cast("binary")).alias("entries_md5"), F.array_join(F.transform("verdict_sids", lambda x: x.cast("string")), ",").alias("sids"),
        F.col("inline.threat").alias("threat_name"), F.col("inline.sid").alias("threat_sid"),
    )


def label_basis(spark, sf_dir):
    return entries(views(spark, sf_dir)).groupBy("source", "label_basis").agg(F.count("*").alias("entries"), F.count_distinct("sid").alias("sids"))


def correlation_counts(spark, sf_dir):
    v = views(spark, sf_dir)
    return correlate.counts(placed(v), v["flows"])


def unmatched_detections(spark, sf_dir):
    out = placed(views(spark, sf_dir)).where("reason is not null")
    return out.select("did", "ts_us", "source_id", "sid", "reason").orderBy("ts_us", "source_id", "sid", "did")


def label_violations(spark, sf_dir):
    """Labels of which some are broken on purpose, by the number in their flow's uid."""
    l = labels.label_entries(labels.consolidate(entries(views(spark, sf_dir))))
    n = F.substring("uid", 2, 12).cast("bigint")
    verdict = lambda x: x["name"] == "verdict"
    broken = l.withColumns({
        "best_tier": F.when(n % 100 == 32, 3).otherwise(F.col("best_tier")),
        "sources": F.when(n % 100 == 33, F.slice("sources", 1, 0)).otherwise(F.col("sources")),
        "labels": F.when(n % 100 == 34, F.filter("labels", lambda x: ~verdict(x))).when(n % 100 == 35, F.concat("labels", F.filter("labels", verdict)))
        .when(n % 100 == 36, F.transform("labels", lambda x: F.when(verdict(x), x.withField("value", F.lit(""))).otherwise(x))).when(n % 100 == 37, F.transform("labels", lambda x: F.when(verdict(x), x.withField("sids", F.concat(x["sids"], F.array(F.lit(-1).cast("bigint"))))).otherwise(x)))
        .otherwise(F.col("labels")),
    })
    return labels.violations(broken)


def identify_suppression(spark, sf_dir):
    v = views(spark, sf_dir)
    return labels.suppressed(v["dets"], v["terms"])


KEY = ["sid", "src_ip", "src_port", "dst_ip", "dst_port", "proto"]


def device_dedup(spark, sf_dir):
    inline = views(spark, sf_dir)["dets"].where("tier = 1")
    return labels.first_per_key(inline, KEY, ["alert_us", "did"]).select("did", "sid", "alert_us", "firings")


def device_ruleset_lookup(spark, sf_dir):
    v = views(spark, sf_dir)
    inline = v["dets"].where("tier = 1").withColumn("ruleset", F.concat(F.lit("content-"), F.col("rev").cast("string"), F.when(F.col("source_id") > 4, F.concat(F.lit("/config-"), F.col("source_id").cast("string"))).otherwise("")))
    return tier1.with_first_ruleset(inline, KEY).groupBy("first_ruleset").agg(F.count("*").alias("detections"), F.count_if(F.col("ruleset") == F.col("first_ruleset")).alias("own"))


def unlabelled_licences(spark, sf_dir):
    """Licence of every source that a notice must name: those of labels and those of unmatched detections."""
    v = views(spark, sf_dir)
    p = placed(v).join(F.broadcast(v["terms"]), "source_id").where("source_class <> 'identify'")
    return p.groupBy("source", "licence").agg(F.count("uid").alias("labelled"), F.count("reason").alias("unmatched"))


def loss_conditions(spark, sf_dir):
    """One row per capture: which losses happened; null where nothing was measured."""
    v = views(spark, sf_dir)
    p = placed(v)
    by = p.withColumn("capture", F.concat(F.lit("cap"), (F.expr("did div 1000") % 7).cast("string"))).groupBy("capture")
    out = by.agg(*[F.bool_or(F.coalesce(F.col("reason") == r, F.lit(False))).alias(k) for k, r in (("detection_uncorrelatable", "no_flow_match"), ("ambiguous_flow_match", "ambiguous_flow_match"), ("unsupported_transport", "unsupported_transport"))])
    all_ = v["flows"].select("capture").distinct().unionByName(spark.sql("SELECT 'capnone' AS capture"))
    return all_.join(out, "capture", "left")


def replay_window(spark, sf_dir):
    """Wall clock to capture time by an affine map: the first and last flow of a capture on a window of 15 seconds."""
    f = views(spark, sf_dir)["flows"]
    w = f.groupBy("capture").agg(F.min("ts_first_us").alias("a"), F.max("ts_last_us").alias("b"), F.count("*").alias("flows"))
    none, wall = F.lit(0).cast("bigint"), F.lit(15_000_000).cast("bigint")
    scale = replay.scale(F.col("a"), F.col("b"), none, wall, F.lit(1.0))
    return w.select("capture", "flows", scale.alias("scale"), replay.capture_time(F.lit(7_500_000), F.col("a"), none, scale).alias("middle_us"))


#: Flows of one tuple and capture; a replay of fifteen seconds and a bit that was asked to be a million times as fast.
_TUPLE = ["capture", "proto", "src_ip", "src_port", "dst_ip", "dst_port"]
_WALL, _TIMES = 15_300_000, 14_000_000


def separability(spark, sf_dir):
    """Flows of reused tuples, the error of a time that a replay gives them, and whether it could tell them apart."""
    f = views(spark, sf_dir)["flows"].select("uid", *_TUPLE, "ts_first_us", "ts_last_us")
    span = f.groupBy("capture").agg(F.min("ts_first_us").alias("a"), F.max("ts_last_us").alias("b"))
    times = (F.col("b") - F.col("a")) / F.lit(_TIMES)
    error = replay.uncertainty(F.col("a"), F.col("b"), F.lit(0).cast("bigint"), F.lit(_WALL).cast("bigint"), times, F.col("capture") == "cap3")
    known = f.join(span.select("capture", error.alias("error")), "capture")
    return replay.separable(known, _TUPLE, F.col("error")).select("uid", F.round("error", 0).cast("bigint").alias("error_us"), "separable")


def log_window(spark, sf_dir):
    """Detections in a flow's padded window, two minutes on either side."""
    v = views(spark, sf_dir)
    w = v["flows"].select("uid", "proto", "src_ip", (F.col("ts_first_us") - 120_000_000).alias("a"), (F.col("ts_last_us") + 120_000_000).alias("b"))
    d = v["dets"].where("tier = 1").select("did", "proto", "src_ip", "ts_us")
    return correlate.in_windows(w, d, ["proto", "src_ip"], 5 * 86_400_000_000)


QUERIES = {
    "p17_separability": (
        separability,
        f"""{duck('flows')}, s AS (SELECT capture, min(ts_first_us) AS a, max(ts_last_us) AS b FROM flows GROUP BY 1),
e AS (SELECT capture, CASE WHEN capture = 'cap3' THEN CAST(b - a AS double) ELSE abs({_WALL}.0::double - CAST(b - a AS double) / ((b - a) / {_TIMES}.0::double)) * (CAST(b - a AS double) / {_WALL}) END AS error FROM s),
w AS (SELECT f.*, e.error, max(ts_last_us) OVER (PARTITION BY {', '.join('f.' + c for c in _TUPLE)} ORDER BY ts_first_us, ts_last_us, uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended,
  lead(ts_first_us) OVER (PARTITION BY {', '.join('f.' + c for c in _TUPLE)} ORDER BY ts_first_us, ts_last_us, uid) AS following FROM flows f JOIN e USING (capture))
SELECT uid, CAST(round(error) AS bigint) AS error_us, coalesce(ts_first_us - ended > error, true) AND coalesce(following - ts_last_us > error, true) AS separable FROM w""",
    ),
    "correlate_placement": (correlate_placement, f"{duck('dets', 'terms')}, {PLACED} SELECT did, uid, reason, how FROM placed"),
    "j04_placement_counts": (placement_counts, f"{duck('dets')}, {PLACED} SELECT coalesce(reason, how) AS placement, count(*) AS detections FROM placed GROUP BY 1"),
    "j01_j03_bidirectional_join": (bidirectional_candidates, f"{duck('dets')}, {PLACED} SELECT did, count(*) AS candidates, min(uid) AS first_uid FROM cand JOIN dets USING (did) WHERE proto = '' OR lower(proto) IN ('tcp', 'udp', 'icmp') GROUP BY did"),
    "label_consolidation": (
        label_consolidation,
        f"""{duck('dets', 'terms')}, {PLACED}, {ENTRIES},
inline AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY (alert_us = 0)::int, alert_us, sid, threat) AS r FROM entries WHERE tier = 1 AND threat <> 'unnamed')
SELECT e.uid, min(e.tier) AS best_tier, count(*) AS sources, md5(string_agg(concat_ws('|', tier, source, e.sid, rev, direction, e.threat, licence, admission_basis, label_basis), chr(10) ORDER BY tier, source, e.sid, rev, direction, e.threat, licence, admission_basis, label_basis)) AS entries_md5, array_to_string(list_sort(list(DISTINCT e.sid)), ',') AS sids, any_value(i.threat) AS threat_name, any_value(i.sid) AS threat_sid
FROM entries e LEFT JOIN (SELECT uid, threat, sid FROM inline WHERE r = 1) i ON e.uid = i.uid GROUP BY e.uid""",
    ),
    "r16_r17_label_basis": (label_basis, f"{duck('dets', 'terms')}, {PLACED}, {ENTRIES} SELECT source, label_basis, count(*) AS entries, count(DISTINCT sid) AS sids FROM entries GROUP BY 1, 2"),
    "a04_correlation_counts": (
        correlation_counts,
        f"""{duck('dets')}, {PLACED}
SELECT count(*) AS detections_total, count(reason) AS unmatched, count(*) FILTER (reason = 'unsupported_transport') AS unsupported_transport, count(DISTINCT uid) AS labels, (SELECT count(*) FROM flows) AS flows_total,
 count(*) - count(*) FILTER (reason = 'unsupported_transport') AS correlatable_total,
 round(CAST(count(*) FILTER (reason IN ('no_flow_match', 'ambiguous_flow_match')) AS double) / (count(*) - count(*) FILTER (reason = 'unsupported_transport')), 9) AS unmatched_ratio FROM placed""",
    ),
    "o03_unmatched_detections": (unmatched_detections, f"{duck('dets')}, {PLACED} SELECT did, ts_us, source_id, sid, reason FROM placed WHERE reason IS NOT NULL"),
    "v01_v02_label_violations": (
        label_violations,
        f"""{duck('dets', 'terms')}, {PLACED}, {ENTRIES}, l AS (SELECT DISTINCT uid, CAST(substr(uid, 2, 12) AS bigint) % 100 AS n FROM entries),
r(n, rule) AS (VALUES (32, 'best tier is not the least'), (32, 'verdict tier is not the best'), (33, 'no sources'), (33, 'best tier is not the least'), (33, 'sids without a source'), (34, 'not exactly one verdict'), (35, 'not exactly one verdict'), (35, 'names repeat or are not sorted'),
 (36, 'empty value'), (37, 'sids empty, unsorted or repeated'), (37, 'sids without a source'))
SELECT uid, rule FROM l JOIN r USING (n)""",
    ),
    "f02_identify_suppression": (identify_suppression, f"{duck('dets', 'terms')} SELECT tier, count(*) FILTER (source_class = 'identify') AS suppressed, count(*) FILTER (source_class <> 'identify') AS kept FROM dets JOIN terms USING (source_id) GROUP BY tier"),
    "a09_device_dedup": (
        device_dedup,
        f"""{duck('dets')}, x AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(KEY)} ORDER BY alert_us, did) AS r, count(*) OVER (PARTITION BY {', '.join(KEY)}) AS firings FROM dets WHERE tier = 1)
SELECT did, sid, alert_us, firings FROM x WHERE r = 1""",
    ),
    "j10_device_ruleset_lookup": (
        device_ruleset_lookup,
        f"""{duck('dets')}, x AS (SELECT *, concat('content-', rev, CASE WHEN source_id > 4 THEN concat('/config-', source_id) ELSE '' END) AS ruleset FROM dets WHERE tier = 1),
y AS (SELECT ruleset, first_value(ruleset) OVER (PARTITION BY {', '.join(KEY)} ORDER BY did) AS first_ruleset FROM x)
SELECT first_ruleset, count(*) AS detections, count(*) FILTER (ruleset = first_ruleset) AS own FROM y GROUP BY 1""",
    ),
    "j15_notice_licences": (unlabelled_licences, f"{duck('dets', 'terms')}, {PLACED} SELECT source, licence, count(uid) AS labelled, count(reason) AS unmatched FROM placed JOIN terms USING (source_id) WHERE source_class <> 'identify' GROUP BY 1, 2"),
    "a13_loss_conditions": (
        loss_conditions,
        f"""{duck('dets')}, {PLACED},
m AS (SELECT concat('cap', (did // 1000) % 7) AS capture, bool_or(coalesce(reason = 'no_flow_match', false)) AS detection_uncorrelatable, bool_or(coalesce(reason = 'ambiguous_flow_match', false)) AS ambiguous_flow_match, bool_or(coalesce(reason = 'unsupported_transport', false)) AS unsupported_transport FROM placed GROUP BY 1)
SELECT a.capture, m.detection_uncorrelatable, m.ambiguous_flow_match, m.unsupported_transport FROM (SELECT DISTINCT capture FROM flows UNION ALL SELECT 'capnone') a LEFT JOIN m USING (capture)""",
    ),
    "p17_replay_window": (replay_window, f"{duck('flows')}, w AS (SELECT capture, min(ts_first_us) AS a, max(ts_last_us) AS b, count(*) AS flows FROM flows GROUP BY 1) SELECT capture, flows, CAST(b - a AS double) / 15000000 AS scale, CAST(round_even(a + 7500000 * (CAST(b - a AS double) / 15000000), 0) AS bigint) AS middle_us FROM w"),
    "f10_log_window": (log_window, f"{duck('dets')} SELECT f.uid, count(d.did) AS detections FROM flows f LEFT JOIN dets d ON d.tier = 1 AND d.proto = f.proto AND d.src_ip = f.src_ip AND d.ts_us BETWEEN f.ts_first_us - 120000000 AND f.ts_last_us + 120000000 GROUP BY 1"),
}
