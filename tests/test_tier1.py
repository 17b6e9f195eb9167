"""Device entries as detections, both tiers together, and what the device lost."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.net import packed
from tidemark.operators import constraints, correlate, labels, store, tier1
from tidemark.sources import engines, feeds

ENTRY = "receive_time string, subtype string, src string, dst string, sport string, dport string, proto string, app string, threatid string, tid string, direction string, contentver string, config_ver string, thr_category string"


def entry(at="2026/08/12 10:11:12", subtype="vulnerability", sport="1024", threat="Bad Thing(31)", direction="client-to-server", proto="TCP", content="c-1"):
    return (at, subtype, "10.0.0.1", "10.0.0.2", sport, "443", proto, "web", threat, None, direction, content, "7", "code-execution")


@pytest.fixture(scope="module")
def log(spark):
    rows = [entry("2026/08/12 10:11:13"), entry(), entry("2026/08/12 10:11:14"), entry(sport="n/a", direction="?", proto="IPv6-ICMP"), entry(subtype="url"), entry(threat="no number"), entry("never", threat="")]
    return spark.createDataFrame(rows, ENTRY)


def test_entries(log):
    got = tier1.detections(log).collect()
    assert len(got) == 4 and {r["tier"] for r in got} == {1}
    first = got[0]
    assert (first["sid"], first["rev"], first["threat"], first["classtype"], first["proto"], first["direction"], first["ruleset"]) == (31, 0, "Bad Thing", "code-execution", "tcp", "to_server", "c-1/config-7")
    assert (got[3]["src_port"], got[3]["direction"], got[3]["proto"]) == (0, "unknown", "icmp")
    assert sorted(r["why"] for r in tier1.declined(log).collect()) == ["no threat id", "no threat id", "subtype url"]


def test_the_earliest_of_each_key_is_kept_in_order(log):
    kept = tier1.deduplicated(tier1.detections(log).repartition(3)).collect()
    assert [(r["ts_us"] // 1_000_000 % 60, r["src_port"], r["firings"]) for r in kept] == [(12, 0, 1), (12, 1024, 3)]


def test_union_has_one_schema(spark, log):
    two = spark.createDataFrame([("feed", 2, 5, 1, None, None, "x", 9, "a", 1, "b", 2, "udp", "unknown")], "source string, tier int, sid int, rev int, classtype string, app_proto string, threat string, ts_us long, src_ip string, src_port int, dst_ip string, dst_port int, proto string, direction string")
    both = tier1.union(tier1.detections(log), two)
    assert both.columns == tier1.COLUMNS and both.count() == 5
    assert tier1.union(tier1.detections(log.limit(0)), two).count() == 1


def test_loss(spark):
    rows = [({"spyware": 1, "url": 5}, {"spyware": 4, "url": 50, "virus": 3, "anti-virus": 2}, 5), ({"spyware": 9}, {"spyware": 1}, 0), ({}, {"vulnerability": 7}, 5)]
    df = spark.createDataFrame(rows, "a map<string, long>, b map<string, long>, n long").withColumn("w", tier1.written(F.col("a"), F.col("b")))
    assert [(r["w"], r["l"]) for r in df.select("w", tier1.loss(F.col("n"), F.col("w")).alias("l")).collect()] == [(5, None), (0, None), (7, "7 written, 5 retrieved: 2 missing")]


def test_addresses_order_by_their_bytes(spark):
    import ipaddress

    texts = ["10.0.0.2", "9.255.0.1", "::", "::1", "2001:db8::8:800:200c:417a", "2001:db8::", "fe80::1", "::ffff:192.0.2.1", "1:2:3:4:5:6:7:8", "0.0.0.0"]
    got = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in texts], "ip string").select("ip", packed(F.col("ip"))).collect()}
    assert got == {t: ipaddress.ip_address(t).packed.hex() for t in texts}


def test_flow_key_of_ipv6(spark):
    import hashlib

    rows = [("tcp", "2001:db8::1", 5, "::1", 6, 0), ("tcp", "::1", 6, "2001:db8::1", 5, 0)]
    df = spark.createDataFrame(rows, "proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_first_us long")
    want = hashlib.sha256(b"cap|tcp|6|::1:6|2001:db8::1:5|1970-01-01T00:00:00.000000Z").hexdigest()[:16]
    assert {r[0] for r in df.select(store.flow_key(F.lit("cap"), F.lit(6))).collect()} == {want}


def test_a_sid_of_two_sources_and_a_source_without_terms_fail(spark):
    index = spark.createDataFrame([(1, "a", "signature"), (1, "b", "signature"), (2, "a", "signature"), (2, "a", "signature")], "sid long, source string, source_class string")
    assert engines.unclaimed(index.where("sid = 2")).count() == 1
    with pytest.raises(PySparkException, match="claimed by a and b"):
        engines.unclaimed(index).collect()
    placed = spark.createDataFrame([("u", 1, 7)], "uid string, source_id int, sid long")
    terms = spark.createDataFrame([(2, "s", "signature")], "source_id int, source string, source_class string")
    with pytest.raises(PySparkException, match="no terms of source 1"):
        labels.entries(placed, terms, spark.createDataFrame([], "sid long, address_indicator boolean")).collect()


def test_windows_count_as_a_scan_does(spark):
    import random

    rng = random.Random(3)
    windows = [(f"u{i}", rng.choice("xy"), a := rng.randint(-500, 500), a + rng.choice([0, 3, 90, 400])) for i in range(60)]
    dets = [(i, rng.choice("xy"), rng.randint(-500, 900)) for i in range(300)]
    got = correlate.in_windows(spark.createDataFrame(windows, "uid string, k string, a long, b long"), spark.createDataFrame(dets, "did long, k string, ts_us long"), ["k"], 100).collect()
    assert {r[0]: r[1] for r in got} == {u: sum(k == x and a <= t <= b for _, x, t in dets) for u, k, a, b in windows}


SOURCE = '[[source]]\nname="{}"\nurl="u"\nlicence="MIT"\nsource_class="signature"\nadmission_basis="{}"\n'


def test_registry_guards(spark):
    df, _ = feeds.registry(spark, SOURCE.format("et/open", "metadata-filter") + SOURCE.format("b", "wholesale") + "enabled=false\n")
    assert df.count() == 2 and [r["name"] for r in feeds.enabled(df).collect()] == ["et/open"]
    for bad in (SOURCE.format("b", "metadata-filter"), SOURCE.format("b", "wholesale") + 'exclude_classtypes=["a b"]\n', SOURCE.format("b", "wholesale") + 'exclude_msg_markers=["ab"]\n'):
        with pytest.raises(feeds.BadFeed):
            feeds.registry(spark, bad)


def test_counts_and_snapshots(spark):
    rows = [(5, 3, 1), (3, 5, 0), (5, 1, 2), (5, -1, 0)]
    got = constraints.counts(spark.createDataFrame(rows, "detections_total long, unmatched long, unsupported_transport long")).collect()
    assert {(r["unmatched"], r["rule"]) for r in got} == {(5, "more unmatched than detections"), (1, "unsupported exceed the unmatched"), (-1, "unsupported exceed the unmatched"), (-1, "negative")}
    constraints.same_snapshot("a", "a")
    with pytest.raises(constraints.Violated):
        constraints.same_snapshot("a", None)


def test_collection_order(spark):
    rows = [("b", "2", "x"), ("a", "2", "y"), ("a", "2", "x"), ("a", "1", "z")]
    got = store.collection_order(spark.createDataFrame(rows, "capture_sha256 string, ts_first string, flow_key string")).collect()
    assert [tuple(r) for r in got] == sorted(rows)
