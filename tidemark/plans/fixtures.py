"""Flows, detections, rules and runs derived from the driver's tables, as SQL that both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The nine feeds with their licence, class, and basis of admission.
TERMS = [
    (0, "et/open", "MIT", "signature", "metadata-filter"),
    (1, "stamus/lateral", "GPL-3.0-only", "signature", "wholesale"),
    (2, "malsilo/win-malware", "MIT", "signature", "wholesale"),
    (3, "the-hunters-ledger/open", "CC-BY-4.0", "signature", "wholesale"),
    (4, "pawpatrules", "CC-BY-SA-4.0", "signature", "wholesale"),
    (5, "abuse.ch/feodotracker", "CC0-1.0", "ioc-dest", "wholesale"),
    (6, "abuse.ch/sslbl-blacklist", "CC0-1.0", "ioc-dest", "wholesale"),
    (7, "abuse.ch/urlhaus", "CC0-1.0", "ioc-name", "wholesale"),
    (8, "oisf/trafficid", "MIT", "identify", "wholesale"),
]
BASE = ("orders", "lineitem", "events", "part", "supplier", "customer")

#: name -> (tables it reads, SQL with {us:column} for microseconds of a timestamp)
_SQL = {
    "flows": (
        ("orders",),
        """SELECT concat('C', lpad(CAST(o_orderkey AS string), 12, '0')) AS uid, concat('cap', CAST(o_orderkey % 7 AS string)) AS capture,
  CASE o_orderstatus WHEN 'O' THEN 'tcp' WHEN 'F' THEN 'udp' ELSE 'icmp' END AS proto,
  concat('10.0.', CAST(o_custkey % 8 AS string), '.', CAST(o_custkey % 250 AS string)) AS src_ip,
  CASE WHEN o_orderstatus = 'P' THEN 8 ELSE CAST(1024 + o_custkey % 500 AS int) END AS src_port,
  concat('198.51.100.', CAST(o_orderkey % 40 AS string)) AS dst_ip,
  CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderstatus = 'O' THEN 443 ELSE 53 END AS dst_port,
  {us:o_orderdate} AS ts_first_us, {us:o_orderdate} + CAST(o_orderkey % 40 AS bigint) * 86400000000 AS ts_last_us, o_orderkey
FROM orders""",
    ),
    "dets": (
        ("lineitem", "flows"),
        """SELECT l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS did,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS tier, CAST(l_suppkey % 9 AS int) AS source_id, CAST(l_partkey AS bigint) AS sid, CAST(1 + l_suppkey % 3 AS bigint) AS rev,
  {us:l_shipdate} AS ts_us, CASE WHEN l_partkey % 23 = 0 THEN 0 ELSE {us:l_shipdate} END AS alert_us,
  CASE WHEN l_returnflag = 'A' AND l_partkey % 10 = 0 THEN 'unnamed' ELSE concat('threat-', CAST(l_partkey % 50 AS string)) END AS threat,
  CASE WHEN l_linenumber % 2 = 0 THEN 'to_server' ELSE 'to_client' END AS direction,
  CASE WHEN l_partkey % 97 = 0 THEN 'esp' ELSE f.proto END AS proto,
  CASE WHEN l_linenumber % 2 = 0 THEN f.src_ip ELSE f.dst_ip END AS src_ip,
  CASE WHEN f.proto = 'icmp' THEN CASE WHEN l_linenumber % 2 = 0 THEN 8 ELSE 0 END WHEN l_linenumber % 2 = 0 THEN f.src_port ELSE f.dst_port END AS src_port,
  CASE WHEN l_linenumber % 2 = 0 THEN f.dst_ip ELSE f.src_ip END AS dst_ip,
  CASE WHEN f.proto = 'icmp' THEN 0 WHEN l_partkey % 89 = 0 THEN 9 WHEN l_linenumber % 2 = 0 THEN f.dst_port ELSE f.src_port END AS dst_port
FROM lineitem JOIN flows f ON l_orderkey = f.o_orderkey""",
    ),
    "terms": ((), "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{lic}', '{c}', '{b}')" for i, n, lic, c, b in TERMS) + ") AS t(source_id, source, licence, source_class, admission_basis)"),
    "all_runs": (
        ("events",),
        """SELECT concat('r', lpad(CAST(event_id AS string), 8, '0')) AS run_id, concat('cap', CAST(user_id % 40 AS string)) AS capture_sha256,
  CASE event_type WHEN 'click' THEN 'replay' WHEN 'view' THEN 'offline' WHEN 'signup' THEN 'replay' ELSE 'both' END AS mode,
  {us:ts} - {us:ts} % 3600000000 AS finished_us, event_type, CAST(event_id % 5 AS int) AS m5, event_id, user_id
FROM events""",
    ),
    "exclusions": (("all_runs",), "SELECT run_id, 'retracted' AS reason FROM all_runs WHERE event_type = 'error' AND m5 = 0"),
    "rule_lines": (
        ("part",),
        """SELECT CAST(p_partkey AS bigint) AS line_no, concat('feed', CAST(p_partkey % 3 AS string)) AS source,
  concat(CASE WHEN p_partkey % 11 = 0 THEN '#' ELSE '' END, 'alert tcp $HOME_NET any -> ', CASE WHEN p_partkey % 97 = 0 THEN '![10.0.0.0/8,$HOME_NET]' ELSE 'any' END,
    ' any (msg:"', CASE WHEN p_partkey % 17 = 0 THEN '🐾 - 👁 ' WHEN p_partkey % 19 = 0 THEN '🐾 - 🚨 ' ELSE '' END, p_name, '"; ', CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'content:"x"; ' END,
    'classtype:', CASE WHEN p_partkey % 13 = 0 THEN 'policy-violation' ELSE 'trojan-activity' END, '; metadata:created_at 2020_01_01',
    CASE WHEN p_size % 4 = 1 THEN ', confidence High, signature_severity Major' WHEN p_size % 4 = 2 THEN ', confidence Low, signature_severity Critical' WHEN p_size % 4 = 3 THEN ', confidence High, signature_severity Informational' ELSE '' END,
    '; ', CASE WHEN p_partkey % 29 = 0 THEN 'ja4.hash; ' ELSE '' END, 'sid:', CAST(p_partkey AS string), '; rev:1;)') AS text
FROM part""",
    ),
}


def _text(name: str, duck: bool) -> str:
    out = _SQL[name][1]
    while "{us:" in out:
        head, _, rest = out.partition("{us:")
        column, _, tail = rest.partition("}")
        out = head + (f"epoch_us({column})" if duck else f"unix_micros(CAST({column} AS timestamp))") + tail
    return out


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver's tables and all that is derived from them."""
    out = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE}
    for name, (needs, _) in _SQL.items():
        out[name] = spark.sql(_rename(name), **{n: out[n] for n in needs}) if needs else spark.sql(_text(name, False))
    return out


def _rename(name: str) -> str:
    """The SQL with its tables as parameters, so that no session-wide views are needed."""
    text = _text(name, False)
    for n in _SQL[name][0]:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {n}", f"{word} {{{n}}}")
    return text


def duck(*names: str) -> str:
    """A DuckDB WITH clause that defines ``names`` and what they need."""
    order: list[str] = []

    def need(n: str) -> None:
        if n in _SQL and n not in order:
            for m in _SQL[n][0]:
                need(m)
            order.append(n)

    for n in names:
        need(n)
    return "WITH " + ",\n".join(f"{n} AS ({_text(n, True)})" for n in order)
