"""Queries over rule text: parsing, admission, snapshots."""

from __future__ import annotations

import gzip
import io
import tarfile

import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import corpus, rules, snapshots
from ..sources import feeds, scratch
from .fixtures import duck, views

#: DuckDB's own parsing of the derived rules, and the verdicts in their order of precedence.
JUDGED = """parsed AS (
  SELECT *, trim(text) AS t, regexp_extract(text, '\\bsid\\s*:\\s*(\\d+)', 1) AS sid_text, regexp_extract(text, '\\bclasstype\\s*:\\s*([A-Za-z0-9._-]+)\\s*;', 1) AS classtype,
    regexp_extract(text, '\\bmsg\\s*:\\s*"([^"]*)"', 1) AS msg, regexp_extract(text, '[,:] *confidence ([^,;]+)', 1) AS confidence, regexp_extract(text, 'signature_severity ([^,;]+)', 1) AS severity FROM rule_lines
), judged AS (
  SELECT *, CASE WHEN regexp_matches(t, '^#+\\s*alert\\s') THEN 'disabled' WHEN regexp_matches(t, '^alert\\s') THEN 'active' ELSE 'other' END AS state,
    CASE WHEN NOT regexp_matches(t, '^alert\\s') THEN NULL WHEN confidence = '' THEN 'no_confidence' WHEN lower(confidence) <> 'high' THEN 'low_confidence' WHEN lower(severity) NOT IN ('major', 'critical') THEN 'low_severity'
      WHEN t LIKE '%![10.0.0.0/8,$HOME_NET]%' THEN 'unloadable' WHEN classtype = 'policy-violation' THEN 'classtype' WHEN starts_with(msg, '🐾 - 👁') THEN 'marker' END AS verdict
  FROM parsed
)"""


def _judged(spark, sf_dir):
    return rules.judge(views(spark, sf_dir)["rule_lines"])


def admission_verdicts(spark, sf_dir):
    return _judged(spark, sf_dir).select("line_no", "state", "verdict")


def admission_counters(spark, sf_dir):
    out = rules.balanced(rules.admission(_judged(spark, sf_dir)))
    return out.withColumn("balance", F.col("fetched") - F.col("admitted") - sum(F.col(v) for v in rules.COUNTED))


def feed_yield(spark, sf_dir):
    return rules.yields(_judged(spark, sf_dir))


def rule_fields(spark, sf_dir):
    t = F.col("text")
    lines = views(spark, sf_dir)["rule_lines"]
    return lines.select("line_no", rules.sid(t).alias("sid"), rules.last_sid(t).alias("loaded_sid"), rules.classtype(t).alias("classtype"), rules.metadata(t, "confidence").alias("confidence"), rules.marker(t).alias("marker"), F.contains(t, F.lit("ja4.hash")).alias("ja4"))


def address_indicators(spark, sf_dir):
    lines = views(spark, sf_dir)["rule_lines"]
    return lines.select("line_no", rules.address_indicator(F.trim("text")).alias("address_indicator"), F.size(rules.options(F.trim("text"))).cast("long").alias("options"))


def rendered_rules(spark, sf_dir):
    return rules.rendered(_judged(spark, sf_dir)).select("source", "sid", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def sid_index(spark, sf_dir):
    return rules.sid_index(_judged(spark, sf_dir)).select("source", F.size("sids").cast("long").alias("sids"), F.array_min("sids").alias("first_sid"), F.array_max("sids").alias("last_sid"), "address_indicators")


def sid_collisions(spark, sf_dir):
    """Sids that two sources claim: every ninth is in another feed as well."""
    first = _judged(spark, sf_dir).where("state = 'active' and verdict is null").select("source", rules.sid(F.col("text")).alias("sid"))
    own = first.unionByName(first.where("sid % 9 = 0").select(F.lit("feed9").alias("source"), "sid"))
    return rules.collisions(own)


def index_reconciliation(spark, sf_dir):
    """Rules that the index doesn't have and index entries without a rule."""
    j = _judged(spark, sf_dir)
    have = j.where("state = 'active' and verdict is null").select(rules.sid(F.col("text")).alias("sid"))
    index = j.where("line_no % 7 <> 0").select(rules.sid(F.col("text")).alias("sid")).distinct()
    return rules.reconciled(have, index)


def continued_lines(spark, sf_dir):
    """Rule text that is split over lines after each option, joined again."""
    lines = views(spark, sf_dir)["rule_lines"]
    parts = lines.select("source", "line_no", F.posexplode(F.split("text", "; ")).alias("i", "part"), F.size(F.split("text", "; ")).alias("n"))
    cut = parts.select("source", (F.col("line_no") * 100 + F.col("i")).alias("line_no"), F.when(F.col("i") < F.col("n") - 1, F.concat("part", F.lit("; \\"))).otherwise(F.col("part")).alias("text"))
    joined = rules.logical_lines(cut)
    return joined.select("source", F.expr("line_no div 100").alias("line_no"), "text", "dangling")


def classtype_join(spark, sf_dir):
    v = views(spark, sf_dir)
    known = v["rule_lines"].select(rules.sid(F.col("text")).alias("sid"), rules.classtype(F.col("text")).alias("classtype"), "source")
    return v["dets"].join(known, "sid", "left").groupBy("classtype", "source").agg(F.count("*").alias("detections"))


def marker_census(spark, sf_dir):
    return rules.markers(views(spark, sf_dir)["rule_lines"])


def marker_gate(spark, sf_dir):
    """Feeds whose markers have moved since their policy was written, and markers that nobody reviewed."""
    j = _judged(spark, sf_dir)
    expected = spark.createDataFrame([("feed0", 10), ("feed1", 10_000_000), ("feed2", 0), ("feed9", 5)], "source string, excluded long")
    known = spark.createDataFrame([("🐾",)], "marker string")
    return corpus.marker_gate(rules.balanced(rules.admission(j)), rules.admitted_markers(j), expected, known)


def snapshot_commits(spark, sf_dir):
    """The admitted rules committed as a snapshot, twice, and read back: what it holds, and which write made it."""
    j, root = _judged(spark, sf_dir), scratch.folder(spark, "snapshots")
    data = j.where("line_no % 50 = 0 AND state = 'active' AND verdict IS NULL").select("source", F.concat(F.lit("list"), F.col("line_no").cast("string"), F.lit(".lst")).alias("name"), F.encode(F.repeat("text", 300), "utf-8").alias("content"))
    counters = rules.admission(j)
    name, fresh = snapshots.write(spark, root, snapshots.components(j, data), counters, "2026-01-01T00:00:00Z")
    again, repeated = snapshots.write(spark, root, snapshots.components(j.repartition(5), data), counters, "2026-02-01T00:00:00Z")
    _, parts, warnings = snapshots.load(spark, root)
    held = parts.withColumn("file", F.when(F.col("path") == snapshots.INDEX, "index").when(F.col("path") == snapshots.RULES, "rules").otherwise("data"))
    sizes = held.where("file <> 'index'").groupBy("file").agg(F.count_distinct("path").alias("files"), F.sum(F.length("content")).alias("n")).select(F.concat("file", F.lit(" bytes")).alias("what"), F.lit(None).cast("string").alias("source"), "n")
    index = snapshots.index(parts).groupBy("source").agg(F.count("*").alias("n")).select(F.lit("sids").alias("what"), "source", "n")
    said = spark.createDataFrame([("new", None, int(fresh)), ("new again", None, int(repeated)), ("same id", None, int(name == again)), ("warnings", None, len(warnings))], "what string, source string, n bigint")
    return sizes.unionByName(index).unionByName(said)


#: Rules per feed, and what the number of a feed makes of it: plain, packed, a packed archive.
PER_FEED = 200


def _feed(block: int, texts: list[tuple[int, str]]) -> bytes:
    if block % 3 < 2:
        plain = "".join(t + "\n" for _, t in texts).encode()
        return gzip.compress(plain) if block % 3 else plain
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        files = {f"z/part{k}.rules": "\n".join(t for n, t in texts if n % 2 == k) for k in (1, 0)} | {"lists/seen.lst": "".join(f"{n}\n" for n, _ in texts)}
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))
    return out.getvalue()


def feed_members(spark, sf_dir):
    """Feeds made from the rules, and the files that are in them."""

    def pack(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["line_no"])
        return pa.table({"source": [f"{rows[0]['source']}/{rows[0]['block']}"], "content": pa.array([_feed(rows[0]["block"], [(r["line_no"], r["text"]) for r in rows])], pa.binary())})

    lines = views(spark, sf_dir)["rule_lines"].select("source", F.expr(f"line_no div {PER_FEED}").alias("block"), "line_no", "text")
    made = lines.groupBy("source", "block").applyInArrow(pack, "source string, content binary")
    return feeds.contents(made).select("source", "name", "kind", F.col("bytes").cast("bigint").alias("bytes"))


#: Headers with brackets up to eleven deep, some of them negated, some never closed, the variable within or behind.
NESTED = {
    "depth": "CAST(line_no % 12 AS int)", "bang": "line_no % 3 = 0", "inside": "line_no % 2 = 0", "closed": "line_no % 7 > 0", "name": "CASE WHEN line_no % 5 = 0 THEN '$HOME_NETWORKS' ELSE '$HOME_NET' END",
}


def nested_brackets(spark, sf_dir):
    lines = views(spark, sf_dir)["rule_lines"].select("line_no", *[F.expr(x).alias(k) for k, x in NESTED.items()])
    text = F.expr("""concat('alert tcp any any -> ', CASE WHEN bang THEN '!' ELSE '' END, repeat('[', depth), '10.0.0.0/8', CASE WHEN inside THEN concat(',', name) ELSE '' END,
 repeat(']', CASE WHEN closed THEN depth ELSE greatest(depth - 1, 0) END), CASE WHEN inside THEN '' ELSE concat(',', name) END, ' any (msg:"!$HOME_NET"; sid:1;)')""")
    return lines.select("line_no", rules.negates_home_net(text).alias("negates"))


ADMITTED = "state = 'active' AND verdict IS NULL"
_SPLIT = "len(string_split(text, '; '))"
QUERIES = {
    "f01_admission_verdicts": (admission_verdicts, f"{duck('rule_lines')}, {JUDGED} SELECT line_no, state, verdict FROM judged"),
    "a06_admission_counters": (
        admission_counters,
        f"""{duck('rule_lines')}, {JUDGED} SELECT source, count(*) FILTER (state = 'active') AS fetched, count(*) FILTER ({ADMITTED}) AS admitted, count(*) FILTER (state = 'disabled') AS commented,
 {', '.join(f"count(*) FILTER (verdict = '{v}') AS {v}" for v in rules.COUNTED)}, count(*) FILTER ({ADMITTED} AND contains(text, 'ja3.hash')) AS ja3_admitted, count(*) FILTER ({ADMITTED} AND contains(text, 'ja4.hash')) AS ja4_admitted,
 count(*) FILTER (state = 'active') - count(*) FILTER ({ADMITTED}) - count(*) FILTER (verdict IS NOT NULL) AS balance FROM judged GROUP BY source""",
    ),
    "a26_feed_yield": (feed_yield, f"{duck('rule_lines')}, {JUDGED} SELECT coalesce(source, 'Total') AS source, count(*) FILTER (state = 'active') AS fetched, count(*) FILTER ({ADMITTED}) AS admitted, round(100.0 * CAST(count(*) FILTER ({ADMITTED}) AS double) / nullif(count(*) FILTER (state = 'active'), 0), 4) AS percent FROM judged GROUP BY ROLLUP (source)"),
    "r02_r06_rule_fields": (
        rule_fields,
        f"""{duck('rule_lines')}, {JUDGED} SELECT line_no, CAST(sid_text AS bigint) AS sid, CAST(sid_text AS bigint) AS loaded_sid, nullif(classtype, '') AS classtype, nullif(confidence, '') AS confidence,
 CASE WHEN starts_with(msg, '🐾 - 👁') THEN '👁' WHEN starts_with(msg, '🐾 - 🚨') THEN '🚨' END AS marker, contains(text, 'ja4.hash') AS ja4 FROM judged""",
    ),
    "r07_r08_address_indicators": (address_indicators, f"{duck('rule_lines')} SELECT line_no, NOT (contains(text, 'content:\"x\"') OR contains(text, 'ja4.hash')) AS address_indicator, len(regexp_extract_all(text, ';')) AS options FROM rule_lines"),
    "k06_rendered_rules": (rendered_rules, f"{duck('rule_lines')}, {JUDGED} SELECT source, CAST(sid_text AS bigint) AS sid, md5(text) AS text_md5 FROM judged WHERE {ADMITTED}"),
    "k07_sid_index": (sid_index, f"{duck('rule_lines')}, {JUDGED} SELECT source, count(DISTINCT sid_text) AS sids, min(CAST(sid_text AS bigint)) AS first_sid, max(CAST(sid_text AS bigint)) AS last_sid, count(*) FILTER (NOT (contains(text, 'content:\"x\"') OR contains(text, 'ja4.hash'))) AS address_indicators FROM judged WHERE {ADMITTED} GROUP BY source"),
    "t05_sid_collisions": (sid_collisions, f"{duck('rule_lines')}, {JUDGED} SELECT CAST(sid_text AS bigint) AS sid, 2 AS sources, concat(source, ',feed9') AS claimed_by FROM judged WHERE {ADMITTED} AND CAST(sid_text AS bigint) % 9 = 0"),
    "j08_index_reconciliation": (
        index_reconciliation,
        f"""{duck('rule_lines')}, {JUDGED}, have AS (SELECT CAST(sid_text AS bigint) AS sid FROM judged WHERE {ADMITTED}), idx AS (SELECT DISTINCT CAST(sid_text AS bigint) AS sid FROM judged WHERE line_no % 7 <> 0)
SELECT sid, 'unattributed' AS fault FROM have WHERE sid NOT IN (SELECT sid FROM idx) UNION ALL SELECT sid, 'phantom' FROM idx WHERE sid NOT IN (SELECT sid FROM have)""",
    ),
    "s19_continued_lines": (
        continued_lines,
        f"""{duck('rule_lines')}, x AS (SELECT *, starts_with(text, '#') AS off, length(string_split(text, '; ')[1]) AS head FROM rule_lines)
SELECT source, line_no, CASE WHEN off THEN concat(substr(text, 1, head), '; \\') ELSE text END AS text, false AS dangling FROM x UNION ALL SELECT source, line_no, substr(text, head + 3), false FROM x WHERE off""",
    ),
    "j06_j07_classtype_join": (classtype_join, f"{duck('rule_lines', 'dets')}, {JUDGED} SELECT nullif(j.classtype, '') AS classtype, j.source, count(*) AS detections FROM dets d LEFT JOIN judged j ON d.sid = CAST(j.sid_text AS bigint) GROUP BY 1, 2"),
    "k05_s20_snapshot_commits": (
        snapshot_commits,
        f"""{duck('rule_lines')}, {JUDGED}, a AS (SELECT * FROM judged WHERE {ADMITTED})
SELECT 'rules bytes' AS what, NULL AS source, CAST(sum(strlen(text) + 1) AS bigint) AS n FROM a UNION ALL SELECT 'data bytes', NULL, CAST(sum(strlen(text) * 300) AS bigint) FROM a WHERE line_no % 50 = 0
UNION ALL SELECT 'sids', source, count(DISTINCT sid_text) FROM a GROUP BY source UNION ALL SELECT * FROM (VALUES ('new', NULL, 1), ('new again', NULL, 0), ('same id', NULL, 1), ('warnings', NULL, 0))""",
    ),
    "s17_feed_members": (
        feed_members,
        f"""{duck('rule_lines')}, x AS (SELECT concat(source, '/', line_no // {PER_FEED}) AS source, line_no // {PER_FEED} AS block, line_no, text FROM rule_lines)
SELECT source, 'feed.rules' AS name, 'rules' AS kind, CAST(sum(strlen(text) + 1) AS bigint) AS bytes FROM x WHERE block % 3 < 2 GROUP BY 1
UNION ALL SELECT b.source, concat('z/part', k), 'rules', coalesce(CAST(sum(strlen(text) + 1) - 1 AS bigint), 0) FROM (SELECT DISTINCT source, unnest([0, 1]) AS k FROM x WHERE block % 3 = 2) b LEFT JOIN x ON x.source = b.source AND x.line_no % 2 = k GROUP BY 1, 2
UNION ALL SELECT source, 'seen.lst', 'data', CAST(sum(strlen(CAST(line_no AS varchar)) + 1) AS bigint) FROM x WHERE block % 3 = 2 GROUP BY 1""".replace("concat('z/part', k)", "concat('z/part', k, '.rules')"),
    ),
    "r09_nested_brackets": (
        nested_brackets,
        f"""{duck('rule_lines')}, x AS (SELECT line_no, {', '.join(f'{v} AS {k}' for k, v in NESTED.items())} FROM rule_lines)
SELECT line_no, bang AND name = '$HOME_NET' AND depth > 0 AND (inside OR NOT closed) AS negates FROM x""",
    ),
    "a24_marker_gate": (
        marker_gate,
        f"""{duck('rule_lines')}, {JUDGED}, x(source, excluded) AS (VALUES ('feed0', 10), ('feed1', 10000000), ('feed2', 0), ('feed9', 5)),
c AS (SELECT source, count(*) FILTER (state = 'active') AS fetched, count(*) FILTER (verdict = 'marker') AS marker FROM judged GROUP BY 1),
b AS (SELECT source, fetched, marker, excluded // 10 AS least, CAST(floor(fetched * 0.05) AS bigint) AS most FROM x LEFT JOIN c USING (source)),
f AS (SELECT source, CASE WHEN fetched IS NULL THEN 'not in the snapshot' WHEN marker = 0 THEN 'nothing excluded' WHEN marker < least THEN 'under the floor' WHEN marker > most THEN 'over the ceiling' END AS fault,
 CASE WHEN marker < least THEN concat(marker, ' of ', least) WHEN marker > most THEN concat(marker, ' of ', most) END AS detail FROM b)
SELECT * FROM f WHERE fault IS NOT NULL UNION ALL SELECT source, 'marker nobody reviewed', concat('🚨: ', count(*)) FROM judged WHERE {ADMITTED} AND starts_with(msg, '🐾 - 🚨') GROUP BY 1""",
    ),
    "a24_marker_census": (marker_census, f"{duck('rule_lines')}, {JUDGED}, m AS (SELECT CASE WHEN starts_with(msg, '🐾 - 👁') THEN '👁' WHEN starts_with(msg, '🐾 - 🚨') THEN '🚨' END AS marker FROM judged) SELECT marker, count(*) AS rules, coalesce(marker = '👁', false) AS observing FROM m GROUP BY 1"),
}
