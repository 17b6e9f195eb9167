"""Queries over the label store: attestation, authoritative runs, identities, merged labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlate, labels, store
from ..sources import scratch
from .detections import PLACED
from .fixtures import duck, views

_MODES = "CASE WHEN event_id % 13 = 0 THEN NULL WHEN m5 = 3 THEN 10 ELSE 100 END"


def _runs(v):
    raw = v["all_runs"].withColumns({"rules_loaded": F.expr(_MODES), "total_admitted": F.lit(100), "device_failed": F.expr("event_id % 17 = 0")})
    return store.attest(raw)


def authoritative_runs(spark, sf_dir):
    v = views(spark, sf_dir)
    return store.authoritative(_runs(v), v["exclusions"])


def attestation(spark, sf_dir):
    r = _runs(views(spark, sf_dir))
    return r.select("run_id", F.array_join(F.transform("tiers_attested", lambda t: t.cast("string")), ",").alias("tiers"), F.array_join("attestation_notes", "; ").alias("notes"))


def retracted_runs(spark, sf_dir):
    v = views(spark, sf_dir)
    return v["all_runs"].join(v["exclusions"], "run_id", "left_anti").groupBy("capture_sha256", "mode").agg(F.count("*").alias("runs"), F.max("finished_us").alias("newest_us"))


def newest_runs(spark, sf_dir):
    return views(spark, sf_dir)["all_runs"].select("run_id", "capture_sha256", "mode", "finished_us").orderBy(F.desc("finished_us"), F.desc("run_id")).limit(50)


def duplicate_runs(spark, sf_dir):
    v = views(spark, sf_dir)
    return v["all_runs"].groupBy("capture_sha256", "mode", "finished_us").agg(F.count("*").alias("runs")).where("runs > 1")


def run_identity(spark, sf_dir):
    r = views(spark, sf_dir)["all_runs"]
    return r.select(F.col("run_id").alias("name"), store.run_id(F.col("capture_sha256"), F.col("mode"), store.iso(F.col("finished_us")), F.lit("1.0")).alias("run_id"))


#: Every fifth flow has IPv6 addresses instead, whose order as text isn't that of their bytes.
_SIX = {"src_ip": "CASE WHEN o_orderkey % 5 = 0 THEN concat('2001:db8::', CAST(src_port AS string)) ELSE src_ip END", "dst_ip": "CASE WHEN o_orderkey % 5 = 0 THEN concat('::', CAST(1 + o_orderkey % 40 AS string)) ELSE dst_ip END"}


def flow_identity(spark, sf_dir):
    f = views(spark, sf_dir)["flows"].withColumns({k: F.expr(v) for k, v in _SIX.items()})
    return f.select("uid", store.flow_key(F.col("capture"), F.expr("CASE proto WHEN 'tcp' THEN 6 WHEN 'udp' THEN 17 ELSE 1 END")).alias("flow_key"), store.iso(F.col("ts_first_us")).alias("ts_first"))


#: The runs of a detection: two, by its number among all runs.
_OF = "(did * 7919 + {k} * 104729) % {n}"


def _rows(v):
    """Label rows: each placed detection is in two runs."""
    placed = correlate.place(v["dets"], v["flows"]).where("uid is not null")
    runs = v["all_runs"].select("run_id", "capture_sha256", F.col("event_id").alias("n"))
    total = v["all_runs"].agg(F.max("event_id") + 1).first()[0]
    own = placed.withColumn("n", F.explode(F.array(*[F.expr(_OF.format(k=k, n=total)) for k in (0, 1)])))
    value = F.when(F.expr("sid % 1999 = 0"), "other").otherwise("malicious").alias("value")
    return own.select("n", F.col("uid").alias("flow_key"), "tier", "source_id", "sid", value).join(runs, "n")


def cross_tier_merge(spark, sf_dir):
    v = views(spark, sf_dir)
    out = store.compose(_rows(v), store.authoritative(_runs(v), v["exclusions"]))
    return out.select("capture_sha256", "flow_key", "best_tier", F.array_join(F.transform("sids", lambda x: x.cast("string")), ",").alias("sids"), "sources", "runs", "conflict")


def _documents(v):
    """Label rows as documents: each flow's labels and sources in each of its runs."""
    placed = correlate.place(v["dets"], v["flows"]).where("uid is not null")
    runs = v["all_runs"].select("run_id", "capture_sha256", F.col("event_id").alias("n"))
    total = v["all_runs"].agg(F.max("event_id") + 1).first()[0]
    own = placed.withColumn("n", F.explode(F.array(*[F.expr(_OF.format(k=k, n=total)) for k in (0, 1)])))
    entry = F.struct("tier", F.concat(F.lit("feed"), F.col("source_id").cast("string")).alias("source"), "sid", "rev", "direction")
    named = (F.col("tier") == 1) & (F.col("threat") != "unnamed")
    rows = own.groupBy("n", F.col("uid").alias("flow_key")).agg(
        F.collect_list(entry).alias("sources"), F.min("tier").alias("tier"), F.array_sort(F.collect_set("sid")).alias("sids"), F.max(F.when(F.expr("sid % 1999 = 0"), "other").otherwise("malicious")).alias("value"),
        F.min(F.when(named, F.struct("sid", "threat"))).alias("named"),
    )
    verdict = F.struct(F.lit("verdict").alias("name"), "value", "tier", "sids")
    name = F.struct(F.lit("threat-name").alias("name"), F.col("named.threat").alias("value"), F.lit(1).alias("tier"), F.array("named.sid").alias("sids"))
    labels = F.when(F.col("named").isNull(), F.array(verdict)).otherwise(F.array(name, verdict))
    return rows.select("n", "flow_key", labels.alias("labels"), "sources").join(runs, "n").drop("n")


def merged_labels(spark, sf_dir):
    """Each flow's sources of all authoritative tiers, and of each name the least tier's value."""
    v = views(spark, sf_dir)
    out = store.merge(_documents(v), store.authoritative(_runs(v), v["exclusions"]), strict=False)
    text = lambda *c: F.concat_ws(":", *[x.cast("string") for x in c])
    return out.select(
        "capture_sha256", "flow_key", F.col("best_tier").cast("bigint").alias("best_tier"), F.array_join(F.transform("sources", lambda x: text(x["tier"], x["source"], x["sid"], x["rev"], x["direction"])), " ").alias("sources"),
        F.array_join(F.transform("labels", lambda x: text(x["name"], x["value"], x["tier"], F.array_join(F.transform(x["sids"], lambda i: i.cast("string")), ","))), " ").alias("labels"),
        F.array_join("runs", ",").alias("runs"), F.array_join("conflicts", ",").alias("conflicts"),
    )


#: Flows with an origin or none, some on a transport that the store refuses.
_ORIGINS = {"proto": "CASE WHEN o_orderkey % 50 = 7 THEN 'unknown_transport' ELSE proto END", "uri": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('gs://bucket/', capture, '.pcap') END"}


def ingest_counts(spark, sf_dir):
    """Flows loaded into a store, by transport, beside what the load counted on its run."""
    flows = views(spark, sf_dir)["flows"].withColumns({k: F.expr(x) for k, x in _ORIGINS.items()})
    root, tables = scratch.folder(spark, "store"), {"captures": flows.select("capture").distinct(), "unmatched": flows.where("false").select("uid")}
    store.load(spark, root, "r1", {**tables, "flow_labels": flows}, spark.range(1).select(F.lit("all").alias("capture_sha256")), {"flow_labels": store.flow_gates(allow_missing_origin=True)})
    run = spark.read.parquet(f"{root}/runs")
    kept = store.committed(spark.read.parquet(f"{root}/flow_labels"), run).groupBy("proto").agg(F.count("*").alias("flows"))
    said = run.select(F.explode("refused").alias("gate", "refused"))
    return kept.select(F.concat(F.lit("kept "), "proto").alias("what"), "flows").unionByName(said.select(F.col("gate").alias("what"), F.col("refused").alias("flows")))


def coverage(spark, sf_dir):
    """Per capture: flows, those that the store refuses for their transport, and those without an origin."""
    f = views(spark, sf_dir)["flows"].withColumn("uri", F.expr("CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'gs://bucket/' ELSE concat('gs://bucket/', capture, '.pcap') END"))
    return store.coverage(f)


def label_selection(spark, sf_dir):
    """Flows that carry every kind that is asked for."""
    v = views(spark, sf_dir)
    return labels.selected(labels.kinds(correlate.place(v["dets"], v["flows"])), "verdict", "threat-name")


def committed_rows(spark, sf_dir):
    v = views(spark, sf_dir)
    return store.committed(_rows(v), v["all_runs"].where("event_id % 2 = 0")).groupBy("run_id").agg(F.count("*").alias("rows"))


ATTESTED = f"""att AS (
  SELECT *, (mode IN ('replay', 'both') AND event_id % 17 <> 0) AS one, (mode IN ('offline', 'both') AND coalesce(({_MODES}) = 100, false)) AS two, mode IN ('offline', 'both') AS tried, ({_MODES}) AS loaded FROM all_runs
), tiers AS (SELECT *, 1 AS tier FROM att WHERE one UNION ALL SELECT *, 2 FROM att WHERE two),
auth AS (
  SELECT capture_sha256, tier, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY capture_sha256, tier ORDER BY finished_us DESC NULLS LAST, run_id DESC) AS r FROM tiers t WHERE NOT EXISTS (SELECT 1 FROM exclusions x WHERE x.run_id = t.run_id)
  ) WHERE r = 1
)"""
ROWS = f"""label_rows AS (
  SELECT r.run_id, r.capture_sha256, p.uid AS flow_key, p.tier, p.sid, CASE WHEN p.sid % 1999 = 0 THEN 'other' ELSE 'malicious' END AS value
  FROM (SELECT *, unnest([{_OF.format(k=0, n="total")}, {_OF.format(k=1, n="total")}]) AS n FROM placed, (SELECT max(event_id) + 1 AS total FROM all_runs)) p JOIN all_runs r ON p.n = r.event_id WHERE p.uid IS NOT NULL
)"""
_ISO = "strftime(make_timestamp({}), '%Y-%m-%dT%H:%M:%S.%fZ')"
QUERIES = {
    "w01_authoritative_runs": (authoritative_runs, f"{duck('exclusions')}, {ATTESTED} SELECT * FROM auth"),
    "a27_attestation": (
        attestation,
        f"""{duck('exclusions')}, {ATTESTED} SELECT run_id, concat_ws(',', CASE WHEN one THEN '1' END, CASE WHEN two THEN '2' END) AS tiers,
 concat_ws('; ', CASE WHEN mode IN ('replay', 'both') AND NOT one THEN 'tier 1: the device failed' END, CASE WHEN tried AND loaded IS NULL THEN 'tier 2: a count is missing' WHEN tried AND NOT two THEN 'tier 2: a partial ruleset' END) AS notes FROM att""",
    ),
    "j12_retracted_runs": (retracted_runs, f"{duck('exclusions')} SELECT capture_sha256, mode, count(*) AS runs, max(finished_us) AS newest_us FROM all_runs r WHERE NOT EXISTS (SELECT 1 FROM exclusions x WHERE x.run_id = r.run_id) GROUP BY 1, 2"),
    "s27_o06_newest_runs": (newest_runs, f"{duck('all_runs')} SELECT run_id, capture_sha256, mode, finished_us FROM all_runs ORDER BY finished_us DESC, run_id DESC LIMIT 50"),
    "a29_duplicate_runs": (duplicate_runs, f"{duck('all_runs')} SELECT capture_sha256, mode, finished_us, count(*) AS runs FROM all_runs GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    "run_identity": (run_identity, f"{duck('all_runs')} SELECT run_id AS name, substr(sha256(concat_ws('|', capture_sha256, mode, {_ISO.format('finished_us')}, '1.0')), 1, 16) AS run_id FROM all_runs"),
    "flow_identity": (
        flow_identity,
        f"""{duck('flows')}, six AS (SELECT * REPLACE ({', '.join(f"{v} AS {k}" for k, v in _SIX.items())}) FROM flows),
four AS (SELECT *, list_transform([src_ip, dst_ip], lambda ip: array_to_string(list_transform(string_split(ip, '.'), lambda x: lpad(x, 3, '0')), '.')) AS e FROM six WHERE o_orderkey % 5 <> 0
 UNION ALL SELECT *, ['2001:db8' || lpad(split_part(src_ip, '::', 2), 24, '0'), lpad(split_part(dst_ip, '::', 2), 32, '0')] AS e FROM six WHERE o_orderkey % 5 = 0),
o AS (SELECT *, (e[1] < e[2] OR (e[1] = e[2] AND src_port <= dst_port)) AS fwd, concat(src_ip, ':', src_port) AS a, concat(dst_ip, ':', dst_port) AS b FROM four)
SELECT uid, substr(sha256(concat_ws('|', capture, proto, CASE proto WHEN 'tcp' THEN '6' WHEN 'udp' THEN '17' ELSE '1' END, CASE WHEN fwd THEN a ELSE b END, CASE WHEN fwd THEN b ELSE a END, {_ISO.format('ts_first_us')})), 1, 16) AS flow_key, {_ISO.format('ts_first_us')} AS ts_first FROM o""",
    ),
    "a28_cross_tier_merge": (
        cross_tier_merge,
        f"""{duck('dets', 'exclusions')}, {PLACED}, {ATTESTED}, {ROWS}
SELECT l.capture_sha256, flow_key, min(l.tier) AS best_tier, array_to_string(list_sort(list(DISTINCT sid)), ',') AS sids, count(*) AS sources, count(DISTINCT l.run_id) AS runs, count(DISTINCT value) > 1 AS conflict
FROM label_rows l JOIN auth USING (run_id, tier) GROUP BY 1, 2""",
    ),
    "a28_merged_labels": (
        merged_labels,
        f"""{duck('dets', 'exclusions')}, {PLACED}, {ATTESTED},
own AS (SELECT *, unnest([{_OF.format(k=0, n="total")}, {_OF.format(k=1, n="total")}]) AS n FROM placed, (SELECT max(event_id) + 1 AS total FROM all_runs) WHERE uid IS NOT NULL),
docs AS (SELECT r.run_id, r.capture_sha256, o.uid AS flow_key, min(tier) AS tier, list(DISTINCT sid) AS sids, max(CASE WHEN sid % 1999 = 0 THEN 'other' ELSE 'malicious' END) AS value,
  min(sid) FILTER (tier = 1 AND threat <> 'unnamed') AS named, arg_min(threat, {{'s': sid, 't': threat}}) FILTER (tier = 1 AND threat <> 'unnamed') AS threat FROM own o JOIN all_runs r ON o.n = r.event_id GROUP BY ALL),
s AS (SELECT r.capture_sha256, o.uid AS flow_key, min(o.tier) AS best_tier, string_agg(concat_ws(':', o.tier, 'feed' || source_id, sid, rev, direction), ' ' ORDER BY o.tier, 'feed' || source_id, sid, rev, direction) AS sources, array_to_string(list_sort(list(DISTINCT r.run_id)), ',') AS runs
  FROM own o JOIN all_runs r ON o.n = r.event_id JOIN auth a ON a.run_id = r.run_id AND a.tier = o.tier GROUP BY 1, 2),
e AS (SELECT d.capture_sha256, flow_key, 'verdict' AS name, value, d.tier, sids FROM docs d JOIN auth a ON a.run_id = d.run_id AND a.tier = d.tier
  UNION ALL SELECT d.capture_sha256, flow_key, 'threat-name', threat, 1, [named] FROM docs d JOIN auth a ON a.run_id = d.run_id AND a.tier = 1 WHERE named IS NOT NULL),
m AS (SELECT capture_sha256, flow_key, name, arg_min(value, tier) AS value, min(tier) AS tier, count(DISTINCT value) > 1 AS conflict, array_to_string(list_sort(list_distinct(flatten(list(sids)))), ',') AS sids FROM e GROUP BY 1, 2, 3),
l AS (SELECT capture_sha256, flow_key, string_agg(concat_ws(':', name, value, tier, sids), ' ' ORDER BY name) AS labels, coalesce(string_agg(name, ',' ORDER BY name) FILTER (conflict), '') AS conflicts FROM m GROUP BY 1, 2)
SELECT s.capture_sha256, s.flow_key, best_tier, sources, coalesce(labels, '') AS labels, runs, coalesce(conflicts, '') AS conflicts FROM s LEFT JOIN l USING (capture_sha256, flow_key)""",
    ),
    "f08_f09_ingest_counts": (
        ingest_counts,
        f"""{duck('flows')}, x AS (SELECT * REPLACE ({_ORIGINS['proto']} AS proto) FROM flows)
SELECT concat('kept ', proto) AS what, count(*) AS flows FROM x WHERE proto <> 'unknown_transport' GROUP BY 1 UNION ALL SELECT 'flow_labels: unsupported transport', count(*) FILTER (proto = 'unknown_transport') FROM x UNION ALL SELECT 'flow_labels: without origin', count(*) FILTER (o_orderkey % 3 = 0) FROM x""",
    ),
    "a30_f08_f09_coverage": (coverage, f"{duck('flows')} SELECT capture, count(*) AS flows, count(*) FILTER (proto NOT IN ('tcp', 'udp', 'icmp')) AS refused, count(*) FILTER (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0) AS without_origin, count(*) FILTER (o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0) AS bad_object FROM flows GROUP BY 1"),
    "f07_label_selection": (label_selection, f"{duck('dets')}, {PLACED} SELECT uid FROM placed WHERE uid IS NOT NULL GROUP BY uid HAVING count(*) FILTER (tier = 1 AND threat <> 'unnamed') > 0"),
    "j18_committed_rows": (committed_rows, f"{duck('dets', 'exclusions')}, {PLACED}, {ROWS} SELECT l.run_id, count(*) AS rows FROM label_rows l WHERE l.run_id IN (SELECT run_id FROM all_runs WHERE event_id % 2 = 0) GROUP BY 1"),
}
