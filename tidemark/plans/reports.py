"""Queries over many runs, and over the raw fields of devices and engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import device
from ..operators import corpus, documents, tier1
from .fixtures import duck, views

#: Source entries of runs, from the detections: a run per order modulo 23.
SEEN = """seen AS (SELECT concat('run', CAST((did {div} 1000) % 23 AS string)) AS run_id, concat('snap', CAST(CASE WHEN source_id % 3 = 0 THEN 0 ELSE (did {div} 1000) % 23 % 4 END AS string)) AS snapshot, concat('feed', CAST(source_id AS string)) AS source,
 sid, CASE WHEN sid % 4 = 0 THEN 'indicator-reference' ELSE 'direct' END AS label_basis, CASE WHEN sid % 3 = 0 THEN 'trojan-activity' END AS classtype FROM dets WHERE tier = 2)"""
RUNS = """runs AS (SELECT run_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 100 - CAST(event_id % 3 AS int) END AS rules_loaded, 100 AS total_admitted,
 CASE WHEN event_id % 5 = 0 THEN 'partial' ELSE 'complete' END AS input_status, CAST(event_id % 4 AS int) AS unmatched, CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 2 AS int) END AS discarded_packets FROM all_runs)"""
DEVICE = """device AS (SELECT CAST(l_orderkey AS bigint) * 8 + l_linenumber AS k, CASE l_linenumber % 4 WHEN 0 THEN concat('Some Threat(', CAST(l_partkey AS string), ')') WHEN 1 THEN CAST(l_partkey AS string) WHEN 2 THEN concat('(', CAST(l_suppkey AS string), ')') ELSE 'Bare name' END AS threatid,
 CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS string) ELSE 'x' END AS tid, CASE l_linenumber % 5 WHEN 0 THEN 'c2s' WHEN 1 THEN 'Server-To-Client' WHEN 2 THEN '' ELSE 'to_server' END AS direction,
 CASE l_linenumber % 3 WHEN 0 THEN 'IPv6-ICMP' WHEN 1 THEN 'TCP' ELSE 'icmpv6' END AS proto, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey % 60000 AS string) ELSE 'n/a' END AS port,
 CASE l_linenumber % 6 WHEN 0 THEN 'url' WHEN 1 THEN '' WHEN 2 THEN 'Vulnerability' WHEN 3 THEN 'wildfire' WHEN 4 THEN 'wildfire-virus' ELSE 'spyware' END AS subtype,
 CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE concat('content-', CAST(l_suppkey AS string)) END AS content, CASE WHEN l_linenumber % 2 = 0 THEN '7' ELSE '' END AS config,
 CASE l_linenumber % 3 WHEN 0 THEN '2026/08/12 10:11:12' WHEN 1 THEN '2026-08-12T10:11:12+02:00' ELSE 'never' END AS received, l_partkey AS before, l_suppkey AS after,
 concat('..cap', CAST(l_partkey % 5 AS string), CASE l_linenumber % 3 WHEN 0 THEN '.pcap.gz' WHEN 1 THEN '.PCAPNG' ELSE '' END) AS filename FROM lineitem)"""


def _sql(spark, text: str, name: str, **tables):
    body = text.partition(" AS (")[2].rstrip().removesuffix(")").replace("{div}", "div")
    for t in tables:
        body = body.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(body, **tables)


def _seen(v, spark):
    return _sql(spark, SEEN, "seen", dets=v["dets"])


def triage_totals(spark, sf_dir):
    return corpus.totals(_seen(views(spark, sf_dir), spark))


def prevalence(spark, sf_dir):
    """By the runs that a source was seen in; some sources stand in one snapshot, some in several."""
    seen = _seen(views(spark, sf_dir), spark)
    overall = seen.groupBy("source").agg(F.count_distinct("run_id").alias("captures"), F.count_distinct("snapshot").alias("snapshots"))
    by = seen.groupBy("source", "sid").agg(F.count_distinct("run_id").alias("seen")).join(overall, "source")
    return by.select("source", "sid", "seen", corpus.prevalence(F.col("seen"), F.col("captures"), F.col("snapshots")).alias("prevalence"))


def run_concerns(spark, sf_dir):
    runs = _sql(spark, RUNS, "runs", all_runs=views(spark, sf_dir)["all_runs"])
    return corpus.concerns(runs).select("run_id", F.array_join("concerns", ", ").alias("concerns"))


def warning_rollup(spark, sf_dir):
    runs = corpus.concerns(_sql(spark, RUNS, "runs", all_runs=views(spark, sf_dir)["all_runs"]))
    return corpus.warning_heads(runs.select(F.explode("concerns").alias("c"), "run_id").select(F.concat("c", F.lit(": run "), "run_id").alias("warning")))


def allow_list_review(spark, sf_dir):
    seen = _seen(views(spark, sf_dir), spark).groupBy("source", "sid", "label_basis").agg(F.count("*").alias("entries"))
    tolerated = seen.where("sid % 10 <> 0").select("source", "sid", F.expr("CASE WHEN sid % 11 = 0 THEN 'other' ELSE label_basis END").alias("label_basis"), F.expr("CASE WHEN sid % 7 = 0 THEN 0 ELSE entries END").alias("count_when_measured"))
    stale = spark.sql("SELECT 'gone' AS source, CAST(1 AS bigint) AS sid, 'direct' AS label_basis, CAST(5 AS bigint) AS count_when_measured")
    return corpus.review(seen, tolerated.unionByName(stale))


def most_common(spark, sf_dir):
    """What fired, most entries first; of equals the one that fired first."""
    return documents.most_common(views(spark, sf_dir)["dets"].where("tier = 2"), ["source_id", "sid"], "did").select("source_id", "sid", "n", "first")


#: Failures of three stages of a run; a stage that didn't run has none.
_STAGES = {"flows_failed": "CASE WHEN event_id % 2 = 0 THEN array('a', 'b') END", "engine_failed": "CASE WHEN event_id % 3 = 0 THEN array('b', 'c', 'b') ELSE array() END", "other": "array('a')"}
_COUNTED = {
    "flows": "event_id", "detections": "event_id * 2", "labels": "event_id % 10", "unmatched": "event_id % 4", "unmatched_unsupported_transport": "0", "unmatched_ratio": "round((event_id % 4) / 8.0, 3)",
    "identify_alerts_suppressed": "1", "rules_loaded": "100", "rules_failed": "event_id % 2", "rules_skipped": "0",
}


def run_counts(spark, sf_dir):
    """The counts of each run, null where their stage didn't run, and its failures, each once."""
    r = views(spark, sf_dir)["all_runs"].select("run_id", "event_id", *[F.expr(x).alias(k) for k, x in (_STAGES | _COUNTED).items()])
    section = documents.counts_section(F.expr("event_id % 5 > 0"), F.expr("event_id % 7 > 0")).alias("c")
    failed = F.array_join(documents.failures(*[F.col(k) for k in _STAGES]), ",").alias("failures")
    out = r.select("run_id", section, failed)
    return out.select("run_id", "failures", *[F.col(f"c.{k}").cast("double" if k == "unmatched_ratio" else "bigint").alias(k) for k in documents.COUNTS])


def unsound_runs(spark, sf_dir):
    runs = _sql(spark, RUNS, "runs", all_runs=views(spark, sf_dir)["all_runs"])
    return corpus.unsound(runs.withColumn("state", F.lit("labelled")))


def feed_liveness(spark, sf_dir):
    builds = views(spark, sf_dir)["all_runs"].select(F.col("capture_sha256").alias("workflow"), F.expr("CASE WHEN user_id % 40 = 3 THEN 'failure' WHEN event_type = 'error' THEN 'failure' ELSE 'success' END").alias("conclusion"), F.col("finished_us").alias("created_us"))
    now = 1_800_000_000_000_000
    return corpus.liveness(builds, now, 700.0)


def run_differences(spark, sf_dir):
    d = views(spark, sf_dir)["dets"]
    left = d.select(F.concat(F.lit("file"), ((F.expr("did div 1000")) % 50).cast("string")).alias("name"), F.col("did").alias("pos"), F.col("threat").alias("record")).where("name <> 'file7'")
    right = d.where("did % 501 <> 0").select(F.concat(F.lit("file"), ((F.expr("did div 1000")) % 50).cast("string")).alias("name"), F.col("did").alias("pos"), F.expr("CASE WHEN sid % 997 = 0 THEN 'changed' ELSE threat END").alias("record")).where("name <> 'file9'")
    return corpus.differences(left, right)


#: Files of a run by the last digit of a detection's source.
_NAMES = "CASE source_id WHEN 0 THEN 'zeek/packet_filter.log' WHEN 1 THEN 'suricata/suricata.log' WHEN 2 THEN '.labels.json.partial' WHEN 3 THEN 'zeek/.conn.log.partial' WHEN 4 THEN 'suricata/eve.json' ELSE concat('zeek/log', CAST(source_id AS string)) END"


def comparable_files(spark, sf_dir):
    """Two runs whose files all differ: those that are reported, and where each begins to differ."""
    d = views(spark, sf_dir)["dets"].select(F.expr(_NAMES).alias("name"), F.col("did").alias("pos"), F.col("threat").alias("record"))
    return corpus.differences(d, d.withColumn("record", F.when(F.col("pos") % 3 == 0, "changed").otherwise(F.col("record")))).select("name", "kind", "first")


def bag_equality(spark, sf_dir):
    d = views(spark, sf_dir)["dets"].select("source_id", "sid", "threat")
    return corpus.bag_differences(d, d.where("sid % 150 <> 0")).groupBy("side", "source_id").agg(F.count("*").alias("records"))


def source_agreement(spark, sf_dir):
    """Sources that were admitted but have no terms, or the other way round."""
    v = views(spark, sf_dir)
    have = v["dets"].where("source_id <> 4").select("source_id").distinct()
    return have.withColumn("a", F.lit(1)).join(v["terms"].where("source_id <> 2").select("source_id", F.lit(1).alias("b")), "source_id", "full_outer").where("a is null or b is null").select("source_id", F.when(F.col("a").isNull(), "no rules").otherwise("no terms").alias("fault"))


def device_fields(spark, sf_dir):
    d = _sql(spark, DEVICE, "device", lineitem=views(spark, sf_dir)["lineitem"])
    c = F.col
    return d.select(
        "k", device.threat_id(c("threatid"), c("tid")).alias("threat_id"), device.threat_name(c("threatid")).alias("threat_name"), device.direction(c("direction")).alias("direction"), device.proto(c("proto")).alias("proto"),
        device.port(c("port")).cast("bigint").alias("port"), device.admits(c("subtype")).alias("admits"), device.ruleset(c("content"), c("config")).alias("ruleset"), device.received_us(c("received")).cast("bigint").alias("received_us"),
        device.counter_delta(c("before"), c("after")).cast("bigint").alias("grown"), device.run_directory(c("filename")).alias("directory"),
    )


def declined_subtypes(spark, sf_dir):
    d = _sql(spark, DEVICE, "device", lineitem=views(spark, sf_dir)["lineitem"])
    return d.groupBy(F.lower("subtype").alias("subtype")).agg(F.count_if(device.admits(F.col("subtype"))).alias("admitted"), F.count_if(~device.admits(F.col("subtype"))).alias("declined"))


#: The tier-1 detections as a device's threat log, in the device's words.
_STAMP = {"spark": "date_format(timestamp_micros(ts_us - ts_us % 1000000), 'yyyy/MM/dd HH:mm:ss')", "duck": "strftime(make_timestamp(ts_us - ts_us % 1000000), '%Y/%m/%d %H:%M:%S')"}
ENTRIES = """device_log AS (SELECT concat(threat, '(', CAST(sid AS string), ')') AS threatid, '' AS tid, CASE WHEN sid % 7 = 0 THEN 'url' WHEN sid % 5 = 0 THEN 'Spyware' ELSE 'vulnerability' END AS subtype, CASE WHEN sid % 2 = 0 THEN 'code-execution' ELSE '' END AS thr_category,
 'web' AS app, {stamp} AS receive_time, src_ip AS src, CAST(src_port AS string) AS sport, dst_ip AS dst, CAST(dst_port AS string) AS dport, upper(proto) AS proto, CASE WHEN direction = 'to_server' THEN 'client-to-server' ELSE 's2c' END AS direction, 'content-1' AS contentver, '' AS config_ver, did FROM dets WHERE tier = 1)"""


def _log(v, spark):
    return _sql(spark, ENTRIES.replace("{stamp}", _STAMP["spark"]), "device_log", dets=v["dets"])


def tier_union(spark, sf_dir):
    """Per source, tier and direction: detections of both tiers together, the device's deduplicated."""
    v = views(spark, sf_dir)
    two = v["dets"].where("tier = 2").select(F.concat(F.lit("feed"), F.col("source_id").cast("string")).alias("source"), "tier", "sid", "rev", F.lit(None).cast("string").alias("classtype"), F.lit(None).cast("string").alias("app_proto"), "threat", "ts_us", "src_ip", "src_port", "dst_ip", "dst_port", "proto", "direction")
    both = tier1.union(tier1.deduplicated(tier1.detections(_log(v, spark))), two)
    return both.groupBy("source", "tier", "direction", "classtype").agg(F.count("*").alias("detections"), F.count_distinct("sid").alias("sids"), F.sum(F.col("ts_us").cast("decimal(38,0)")).cast("double").alias("times"))


def declined_entries(spark, sf_dir):
    return tier1.declined(_log(views(spark, sf_dir), spark)).groupBy("why").agg(F.count("*").alias("entries"), F.count_distinct("threat").alias("threats"))


def device_loss(spark, sf_dir):
    """Per log, the counters before and after, summed over the named ones, against what was retrieved."""
    log = _log(views(spark, sf_dir), spark).groupBy((F.expr("did div 8") % 50).alias("log")).agg(F.count("*").alias("retrieved"))
    counters = lambda *n: F.create_map(*[x for k, e in zip(("vulnerability", "spyware", "url", "anti-virus"), n) for x in (F.lit(k), F.expr(e))])
    wrote = tier1.written(counters("log * 10", "100", "0", "5"), counters("log * 10 + retrieved", "100 + log % 3", "1000", "5 - log % 2"))
    return log.select("log", wrote.cast("bigint").alias("written"), tier1.loss(F.col("retrieved"), wrote).alias("loss"))


_SEEN = f"{duck('dets')}, {SEEN.replace('{div}', '//')}"
_RUNS = f"{duck('all_runs')}, {RUNS}"
_LOG = f"{duck('dets')}, {ENTRIES.replace('{stamp}', _STAMP['duck'])}"
_CONCERN = "concat_ws(', ', CASE WHEN rules_loaded <> total_admitted THEN 'partial ruleset' END, CASE WHEN input_status <> 'complete' THEN 'partial input' END, CASE WHEN unmatched > 0 THEN 'unmatched detections' END, CASE WHEN discarded_packets > 0 THEN 'discarded packets' END)"
QUERIES = {
    "a18_triage_totals": (triage_totals, f"{_SEEN} SELECT source, sid, label_basis, classtype, count(*) AS entries, count(DISTINCT run_id) AS runs FROM seen GROUP BY 1, 2, 3, 4"),
    "a19_a22_prevalence": (prevalence, f"{_SEEN}, n AS (SELECT source, count(DISTINCT run_id) AS c, count(DISTINCT snapshot) AS s FROM seen GROUP BY 1) SELECT source, sid, count(DISTINCT run_id) AS seen, CASE WHEN any_value(s) > 1 THEN '' WHEN count(DISTINCT run_id) = 1 THEN 'one' WHEN count(DISTINCT run_id) * 1.0 / any_value(c) >= 2.0 / 3 THEN 'EVERY' ELSE '' END AS prevalence FROM seen JOIN n USING (source) GROUP BY 1, 2"),
    "a20_run_concerns": (run_concerns, f"{_RUNS} SELECT run_id, {_CONCERN} AS concerns FROM runs"),
    "a21_warning_rollup": (warning_rollup, f"{_RUNS}, x AS (SELECT unnest(string_split({_CONCERN}, ', ')) AS head FROM runs) SELECT head, count(*) AS warnings FROM x WHERE head <> '' GROUP BY 1"),
    "j16_a23_allow_list_review": (
        allow_list_review,
        f"""{_SEEN}, s AS (SELECT source, sid, label_basis, count(*) AS entries FROM seen GROUP BY 1, 2, 3), t AS (SELECT source, sid, CASE WHEN sid % 11 = 0 THEN 'other' ELSE label_basis END AS label_basis, CASE WHEN sid % 7 = 0 THEN 0 ELSE entries END AS m FROM s WHERE sid % 10 <> 0 UNION ALL SELECT 'gone', 1, 'direct', 5)
SELECT * FROM (SELECT coalesce(s.source, t.source) AS source, coalesce(s.sid, t.sid) AS sid, coalesce(s.label_basis, t.label_basis) AS label_basis, CASE WHEN t.m IS NULL THEN 'offender' WHEN s.entries IS NULL THEN 'stale' WHEN s.entries > 10 * t.m THEN 'above ceiling' END AS fault FROM s FULL JOIN t ON s.source = t.source AND s.sid = t.sid AND s.label_basis = t.label_basis) WHERE fault IS NOT NULL""",
    ),
    "o07_most_common": (most_common, f"{duck('dets')} SELECT source_id, sid, count(*) AS n, min(did) AS first FROM dets WHERE tier = 2 GROUP BY 1, 2"),
    "a14_a15_run_counts": (
        run_counts,
        f"""{duck('all_runs')} SELECT run_id, CASE WHEN event_id % 6 = 0 THEN 'a,b,c' WHEN event_id % 2 = 0 THEN 'a,b' WHEN event_id % 3 = 0 THEN 'b,c,a' ELSE 'a' END AS failures,
 {', '.join(f"CASE WHEN event_id % {5 if i < 6 else 7} > 0 THEN CAST({_COUNTED[k]} AS {'double' if k == 'unmatched_ratio' else 'bigint'}) END AS {k}" for i, k in enumerate(documents.COUNTS))} FROM all_runs""",
    ),
    "a23_unsound_runs": (
        unsound_runs,
        f"""{_RUNS} SELECT run_id, CASE WHEN rules_loaded IS DISTINCT FROM total_admitted THEN concat('loaded ', coalesce(CAST(rules_loaded AS varchar), 'an unknown number'), ' of ', total_admitted, ' rules') ELSE concat('input is ', input_status) END AS reason
FROM runs WHERE rules_loaded IS DISTINCT FROM total_admitted OR input_status <> 'complete'""",
    ),
    "a25_feed_liveness": (feed_liveness, f"{duck('all_runs')}, n AS (SELECT capture_sha256 AS workflow, max(finished_us) FILTER (user_id % 40 <> 3 AND event_type <> 'error') AS newest FROM all_runs GROUP BY 1) SELECT workflow, round((1800000000000000 - newest) / 86400000000.0::double, 6) AS age_days, newest IS NULL OR (1800000000000000 - newest) / 86400000000.0::double > 700 AS stale FROM n"),
    "j13_w04_run_differences": (
        run_differences,
        f"""{duck('dets')}, l AS (SELECT concat('file', (did // 1000) % 50) AS name, did AS pos, threat AS record FROM dets WHERE (did // 1000) % 50 <> 7),
r AS (SELECT concat('file', (did // 1000) % 50) AS name, did AS pos, CASE WHEN sid % 997 = 0 THEN 'changed' ELSE threat END AS record FROM dets WHERE did % 501 <> 0 AND (did // 1000) % 50 <> 9),
f AS (SELECT coalesce(l.name, r.name) AS name, min(coalesce(l.pos, r.pos)) AS first FROM l FULL JOIN r ON l.name = r.name AND l.pos = r.pos WHERE l.record IS DISTINCT FROM r.record GROUP BY 1)
SELECT name, CASE WHEN name NOT IN (SELECT name FROM r) THEN 'only left' WHEN name NOT IN (SELECT name FROM l) THEN 'only right' ELSE 'differs' END AS kind, first FROM f""",
    ),
    "f05_comparable_files": (
        comparable_files,
        f"""{duck('dets')}, f AS (SELECT {_NAMES} AS name, did FROM dets WHERE did % 3 = 0)
SELECT name, 'differs' AS kind, min(did) AS first FROM f WHERE name NOT IN ('zeek/packet_filter.log', 'suricata/suricata.log') AND name NOT LIKE '%.partial' GROUP BY 1""",
    ),
    "t03_bag_equality": (bag_equality, f"{duck('dets')} SELECT 'left' AS side, source_id, count(*) AS records FROM dets WHERE sid % 150 = 0 GROUP BY 2"),
    "j14_source_agreement": (source_agreement, f"{duck('dets', 'terms')}, h AS (SELECT DISTINCT source_id FROM dets WHERE source_id <> 4), t AS (SELECT source_id FROM terms WHERE source_id <> 2) SELECT source_id, 'no terms' AS fault FROM h WHERE source_id NOT IN (SELECT source_id FROM t) UNION ALL SELECT source_id, 'no rules' FROM t WHERE source_id NOT IN (SELECT source_id FROM h)"),
    "p02_p18_device_fields": (
        device_fields,
        f"""WITH {DEVICE} SELECT k, CASE WHEN regexp_matches(threatid, '^\\d+$') THEN CAST(threatid AS bigint) WHEN regexp_matches(threatid, '\\(\\d+\\)$') THEN CAST(regexp_extract(threatid, '\\((\\d+)\\)$', 1) AS bigint) WHEN regexp_matches(tid, '^\\d+$') THEN CAST(tid AS bigint) END AS threat_id,
 CASE WHEN starts_with(threatid, '(') THEN threatid ELSE regexp_replace(threatid, '\\([^()]*\\)$', '') END AS threat_name, CASE lower(direction) WHEN 'c2s' THEN 'to_server' WHEN 'to_server' THEN 'to_server' WHEN 'server-to-client' THEN 'to_client' ELSE 'unknown' END AS direction,
 CASE WHEN lower(proto) = 'tcp' THEN 'tcp' ELSE 'icmp' END AS proto, CASE WHEN port = 'n/a' THEN 0 ELSE CAST(port AS bigint) END AS port, lower(subtype) NOT IN ('url', 'wildfire') AS admits,
 CASE WHEN content = '' THEN 'unknown-content' ELSE concat(content, CASE WHEN config = '' THEN '' ELSE '/config-7' END) END AS ruleset, CASE received WHEN 'never' THEN 0 WHEN '2026/08/12 10:11:12' THEN epoch_us(TIMESTAMP '2026-08-12 10:11:12') ELSE epoch_us(TIMESTAMP '2026-08-12 08:11:12') END AS received_us,
 greatest(0, after - before) AS grown, regexp_extract(filename, '(cap\\d)', 1) AS directory FROM device""",
    ),
    "t01_tier_union": (
        tier_union,
        f"""{_LOG}, one AS (SELECT sid, direction, CASE WHEN sid % 2 = 0 THEN 'code-execution' END AS classtype, ts_us - ts_us % 1000000 AS ts, row_number() OVER (PARTITION BY sid, src_ip, src_port, dst_ip, dst_port, proto ORDER BY ts_us - ts_us % 1000000, direction) AS r FROM dets WHERE tier = 1 AND sid % 7 <> 0)
SELECT 'device/threat-log' AS source, 1 AS tier, direction, classtype, count(*) AS detections, count(DISTINCT sid) AS sids, CAST(sum(ts) AS double) AS times FROM one WHERE r = 1 GROUP BY ALL
UNION ALL SELECT concat('feed', source_id), tier, direction, NULL, count(*), count(DISTINCT sid), CAST(sum(ts_us) AS double) FROM dets WHERE tier = 2 GROUP BY ALL""",
    ),
    "p23_declined_entries": (declined_entries, f"{_LOG} SELECT 'subtype url' AS why, count(*) AS entries, count(DISTINCT regexp_replace(threatid, '\\(.*', '')) AS threats FROM device_log WHERE subtype = 'url'"),
    "a10_a11_device_loss": (
        device_loss,
        f"""{_LOG}, l AS (SELECT (did // 8) % 50 AS log, count(*) AS retrieved FROM device_log GROUP BY 1)
SELECT log, retrieved + log % 3 AS written, CASE WHEN log % 3 > 0 THEN format('{{}} written, {{}} retrieved: {{}} missing', retrieved + log % 3, retrieved, log % 3) END AS loss FROM l""",
    ),
    "f03_a12_declined_subtypes": (declined_subtypes, f"WITH {DEVICE} SELECT lower(subtype) AS subtype, count(*) FILTER (lower(subtype) NOT IN ('url', 'wildfire')) AS admitted, count(*) FILTER (lower(subtype) IN ('url', 'wildfire')) AS declined FROM device GROUP BY 1"),
}
