import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import correlate, labels

FLOW = "uid string, proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_first_us long, ts_last_us long"
DET = "did long, proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_us long"
A, B, V6 = "10.0.0.1", "198.51.100.7", "2001:db8::1"
FLOWS = [
    ("forward", "tcp", A, 51234, B, 80, 100, 110), ("reverse", "tcp", B, 80, A, 51235, 100, 110), ("other", "tcp", A, 51234, B, 81, 100, 110), ("dns", "udp", A, 53, B, 53, 100, 110),
    ("same", "tcp", A, 7, A, 7, 100, 110), ("echo", "icmp", A, 8, B, 0, 100, 110), ("reply", "icmp", B, 0, A, 8, 200, 210), ("code1", "icmp", A, 3, B, 1, 100, 110), ("code4", "icmp", A, 3, B, 4, 100, 110),
    ("nd", "icmp", V6, 135, "2001:db8::2", 136, 100, 110), ("v6", "icmp", V6, 1, "2001:db8::2", 7, 100, 110), ("tls6", "tcp", V6, 443, "2001:db8::2", 443, 100, 110),
    ("reuse1", "tcp", A, 60000, B, 443, 100, 110), ("reuse2", "tcp", A, 60000, B, 443, 110, 120), ("reuse3", "tcp", A, 60000, B, 443, 300, 310),
]
DETS = [
    ("tcp", A, 51234, B, 80, 105), ("tcp", B, 80, A, 51234, 999), ("tcp", A, 51234, B, 8080, 105), ("udp", B, 53, A, 53, 105), ("tcp", A, 7, A, 7, 105), ("icmp", A, 8, B, 0, 105), ("icmp", B, 0, A, 0, 105),
    ("icmp", A, 3, B, 1, 105), ("icmp", V6, 135, "2001:db8::2", 0, 105), ("icmp", V6, 1, "2001:db8::2", 7, 105), ("icmp", A, 200, B, 7, 105), ("esp", A, 0, B, 0, 105), ("", A, 51234, B, 80, 105), ("TCP", A, 51234, B, 80, 105),
    ("tcp", A, 60000, B, 443, 101), ("tcp", A, 60000, B, 443, 110), ("tcp", A, 60000, B, 443, 200), ("tcp", B, 443, A, 60000, 310), ("tcp", A, 51234, B, 80, 105),
]
WANT = ["forward", "forward", "no_flow_match", "dns", "same", None, None, "code1", "nd", "v6", "no_flow_match", "unsupported_transport", "no_flow_match", "no_flow_match", "reuse1", "ambiguous_flow_match", "ambiguous_flow_match", "reuse3", "forward"]


def theta_place(dets, flows):
    """Placement by comparing every pair."""
    f = flows.select("uid", *[F.col(c).alias(f"f_{c}") for c in correlate.TUPLE], "ts_first_us", "ts_last_us")
    ends = lambda a, b: (F.col("src_ip") == F.col(f"f_{a}_ip")) & (F.col("src_port") == F.col(f"f_{a}_port")) & (F.col("dst_ip") == F.col(f"f_{b}_ip"))
    port = lambda b: (F.col("dst_port") == F.col(f"f_{b}_port")) | ((F.col("proto") == "icmp") & (correlate.counterpart(F.col("src_ip"), F.col("src_port")) == F.col(f"f_{b}_port")))
    fits = (F.col("proto") == F.col("f_proto")) & ((ends("src", "dst") & port("dst")) | (ends("dst", "src") & port("src")))
    pairs = dets.join(f, fits & correlate._supported(), "left")
    inside = F.col("ts_us").between(F.col("ts_first_us"), F.col("ts_last_us"))
    seen = pairs.groupBy("did").agg(F.count("uid").alias("n"), F.count(F.when(inside, F.col("uid"))).alias("k"), F.min("uid").alias("any"), F.min(F.when(inside, F.col("uid"))).alias("inside"))
    reason = F.when(~correlate._supported(), "unsupported_transport").when(F.col("n") == 0, "no_flow_match").when((F.col("n") > 1) & (F.col("k") != 1), "ambiguous_flow_match")
    return dets.join(seen, "did").withColumn("reason", reason).withColumn("uid", F.when(reason.isNull(), F.when(F.col("n") == 1, F.col("any")).otherwise(F.col("inside"))))


def tables(spark, flows=FLOWS, dets=DETS):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(dets)], DET), spark.createDataFrame(flows, FLOW)


def test_truth_table(spark):
    d, f = tables(spark)
    got = {r["did"]: r["uid"] or r["reason"] for r in correlate.place(d, f).collect()}
    for i, want in enumerate(WANT):
        if want:
            assert got[i] == want, (i, DETS[i])


def test_hash_keys_agree_with_every_pair_compared(spark):
    d, f = tables(spark)
    a = {tuple(r) for r in correlate.place(d, f).select("did", "uid", "reason").collect()}
    assert a == {tuple(r) for r in theta_place(d, f).select("did", "uid", "reason").collect()}


def test_random_population_agrees_whatever_its_order(spark):
    rng = random.Random(5)
    kinds = lambda p: rng.choice([0, 3, 8, 13, 14]) if p == "icmp" else rng.choice([53, 80, 1025])
    ips = [A, B, V6]
    one = lambda p: (p, rng.choice(ips), kinds(p), rng.choice(ips), kinds(p))
    flows = [(f"u{i}", *one(rng.choice(["tcp", "icmp"])), t := rng.randrange(100), t + rng.randrange(20)) for i in range(60)]
    dets = [(*one(rng.choice(["tcp", "icmp", "gre", ""])), rng.randrange(120)) for _ in range(150)]
    d, f = tables(spark, flows, dets)
    a = {tuple(r) for r in correlate.place(d, f).select("did", "uid", "reason").collect()}
    assert a == {tuple(r) for r in theta_place(d, f).select("did", "uid", "reason").collect()}
    assert a == {tuple(r) for r in correlate.place(d, f, hot=2).select("did", "uid", "reason").collect()} == {tuple(r) for r in correlate.place(d, f, hot=0).select("did", "uid", "reason").collect()}
    rng.shuffle(flows)
    assert a == {tuple(r) for r in correlate.place(d.repartition(7), spark.createDataFrame(flows, FLOW)).select("did", "uid", "reason").collect()}


def test_join_is_on_the_whole_tuple(spark):
    plan = correlate.candidates(*tables(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and " OR " not in plan.split("Join Inner")[1].split("\n")[0]


def test_icmp_tables_are_symmetric():
    for t in (correlate.ICMP4, correlate.ICMP6):
        assert all(t[b] == a for a, b in t.items())


def test_empty_tables(spark):
    d, f = tables(spark, [], [])
    assert correlate.place(d, f).count() == 0
    row = correlate.counts(correlate.place(d, f), f).first()
    assert row["unmatched_ratio"] == 0.0 and correlate.gate(row) == []


@pytest.mark.parametrize(("lost", "of", "ok"), [(1, 200, True), (1, 100, True), (1, 50, False), (0, 10, True)])
def test_gate(lost, of, ok):
    row = {"unmatched": lost + 1, "unsupported_transport": 1, "correlatable_total": of, "unmatched_ratio": lost / of}
    if ok:
        assert len(correlate.gate(row)) == 1
    else:
        with pytest.raises(correlate.Unmatched):
            correlate.gate(row)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -0.1, 1.1, True, "0.1"])
def test_threshold_has_to_be_a_share(bad):
    with pytest.raises(ValueError):
        correlate.check_threshold(bad)


ENTRY = "uid string, tier int, source string, sid long, rev long, direction string, threat string, licence string, admission_basis string, label_basis string, alert_us long"


def entry(uid="u", tier=1, sid=1, threat="t", at=5, source="s"):
    return (uid, tier, source, sid, 1, "to_server", threat, "MIT", "wholesale", "direct", at)


def consolidated(spark, rows):
    return labels.label_entries(labels.consolidate(spark.createDataFrame(rows, ENTRY)))


def test_threat_name_is_the_earliest_inline_one_with_a_name(spark):
    rows = [entry(sid=9, threat="late", at=8), entry(sid=3, threat="unread", at=0), entry(sid=5, threat="b", at=5), entry(sid=4, threat="a", at=5), entry(sid=2, threat="unnamed", at=1), entry(tier=2, sid=1, threat="engine", at=1)]
    for order in itertools.islice(itertools.permutations(rows), 0, 720, 144):
        r = consolidated(spark, list(order)).first()
        assert (r["inline"]["threat"], r["best_tier"], r["verdict_sids"]) == ("a", 1, [1, 2, 3, 4, 5, 9])
        assert [x["name"] for x in r["labels"]] == ["threat-name", "verdict"]
    only = consolidated(spark, [entry(threat="unread", at=0)]).first()
    assert only["inline"]["threat"] == "unread"
    assert consolidated(spark, [entry(threat="unnamed"), entry(tier=2)]).first()["inline"] is None


def test_repeated_entries_stay_and_labels_are_sound(spark):
    df = consolidated(spark, [entry(), entry(), entry(uid="v", tier=2)])
    assert {r["uid"]: len(r["sources"]) for r in df.collect()} == {"u": 2, "v": 1}
    assert labels.violations(df).count() == 0
    broken = df.withColumn("best_tier", F.lit(7)).withColumn("labels", F.slice("labels", 1, 0))
    assert {r["rule"] for r in labels.violations(broken).collect()} >= {"best tier is not the least", "not exactly one verdict"}


def test_basis_needs_a_known_rule(spark):
    rows = spark.createDataFrame([("signature", False), ("signature", True), ("signature", None), ("ioc-name", False), ("ioc-dest", False)], "c string, i boolean")
    got = [r[0] for r in rows.select(labels.basis(F.col("c"), F.col("i"))).collect()]
    assert got == ["direct", "indicator-reference", "indicator-reference", "indicator-reference", "direct"]


def test_first_firing_survives(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 3, 2), (1, 3, 3), (2, 9, 4)], "sid int, at int, did int")
    got = {(r["sid"], r["did"], r["firings"]) for r in labels.first_per_key(df, ["sid"], ["at", "did"]).collect()}
    assert got == {(1, 2, 3), (2, 4, 1)}


def test_slots_only_deal_events_out(spark):
    rng = random.Random(11)
    flows = [(f"u{i}", "tcp", A, 1, B, 2 + i % 2, t := rng.randrange(1000), t + rng.choice([-1, 0, 3, 400])) for i in range(80)]
    dets = [(*rng.choice([("tcp", A, 1, B, 2), ("tcp", B, 3, A, 1)]), rng.randrange(1100)) for _ in range(300)]
    d, f = tables(spark, flows, dets)
    want = {tuple(r) for r in theta_place(d, f).select("did", "uid", "reason").collect()}
    for hot, slot in ((0, 1), (0, 100), (0, 10_000), (45, 100), (500, 7)):
        assert {tuple(r) for r in correlate.place(d, f, hot, slot).select("did", "uid", "reason").collect()} == want


def test_a_hot_tuple_is_not_quadratic(spark):
    """100,000 flows and as many detections of one tuple: 10^10 pairs, none of which is made."""
    flows = spark.range(100_000).select(F.format_string("u%06d", "id").alias("uid"), F.lit("tcp").alias("proto"), F.lit(A).alias("src_ip"), F.lit(1).alias("src_port"), F.lit(B).alias("dst_ip"), F.lit(2).alias("dst_port"), (F.col("id") * 100).alias("ts_first_us"), (F.col("id") * 100 + F.when(F.col("id") % 10 == 0, 150).otherwise(60)).alias("ts_last_us"))
    dets = spark.range(100_000).select(F.col("id").alias("did"), F.lit("tcp").alias("proto"), F.lit(B).alias("src_ip"), F.lit(2).alias("src_port"), F.lit(A).alias("dst_ip"), F.lit(1).alias("dst_port"), (F.col("id") * 100 + 30 + (F.col("id") % 2) * 50).alias("ts_us"))
    got = {(r["how"], r["reason"]): r["n"] for r in correlate.place(dets, flows, slot_us=100_000).groupBy("how", "reason").agg(F.count("*").alias("n")).collect()}
    # Even ids fall into their own flow; odd ones behind it, into that of the one before if it is long and a multiple of ten.
    odd_inside = sum(1 for i in range(100_000) for t in [i * 100 + 30 + (i % 2) * 50] if sum(j * 100 <= t <= j * 100 + (150 if j % 10 == 0 else 60) for j in (i - 1, i) if j >= 0) == 1)
    assert got == {("clock", None): odd_inside, (None, "ambiguous_flow_match"): 100_000 - odd_inside}


def test_candidates_are_counted_without_pairs(spark):
    """Counts are those of the pairs, ports of ICMP included; 100,000 flows and as many detections of one tuple make none."""
    rng = random.Random(3)
    kinds = lambda p: rng.choice([0, 8, 13, 14]) if p == "icmp" else rng.choice([1, 2, 3])
    one = lambda p: (p, rng.choice([A, B]), kinds(p), rng.choice([A, B]), kinds(p))
    flows = [(f"u{i}", *one(rng.choice(["tcp", "icmp"])), t := rng.randrange(100), t + rng.randrange(20)) for i in range(60)]
    dets = [(*one(rng.choice(["tcp", "icmp", "gre", ""])), rng.randrange(120)) for _ in range(150)]
    d, f = tables(spark, flows + flows[:5], dets)
    pairs = correlate.candidates(d, f).select("did", "uid").distinct().groupBy("did").agg(F.count("*").alias("n"), F.min("uid").alias("lo"))
    assert {tuple(r) for r in correlate.candidate_counts(d, f).collect()} == {tuple(r) for r in pairs.collect()}
    n = 100_000
    f = spark.range(n).select(F.format_string("u%06d", "id").alias("uid"), F.lit("tcp").alias("proto"), F.lit(A).alias("src_ip"), F.lit(1).alias("src_port"), F.lit(B).alias("dst_ip"), F.lit(2).alias("dst_port"), F.col("id").alias("ts_first_us"), F.col("id").alias("ts_last_us"))
    d = spark.range(n).select(F.col("id").alias("did"), F.lit("tcp").alias("proto"), F.lit(B).alias("src_ip"), F.lit(2).alias("src_port"), F.lit(A).alias("dst_ip"), F.lit(1).alias("dst_port"), F.col("id").alias("ts_us"))
    assert [tuple(r) for r in correlate.candidate_counts(d, f).groupBy("candidates", "first_uid").count().collect()] == [(n, "u000000", n)]


def test_placement_reads_detections_once(spark):
    """Each detection goes through one exchange, whatever number of flows its tuple has; repeated flows count once."""
    f = spark.range(900).select(F.format_string("u%03d", F.col("id") % 890).alias("uid"), F.lit("tcp").alias("proto"), F.lit(A).alias("src_ip"), F.lit(1).alias("src_port"), F.lit(B).alias("dst_ip"), (F.col("id") % 3).cast("int").alias("dst_port"), F.col("id").alias("ts_first_us"), (F.col("id") + F.col("id") % 5).alias("ts_last_us"))
    d = spark.range(777).select(F.col("id").alias("did"), F.lit("tcp").alias("proto"), F.lit(A).alias("src_ip"), F.lit(1).alias("src_port"), F.lit(B).alias("dst_ip"), (F.col("id") % 4).cast("int").alias("dst_port"), F.col("id").alias("ts_us"))
    out = correlate.place(d, f)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 777") == 1
    assert {tuple(r) for r in out.select("did", "uid", "reason").collect()} == {tuple(r) for r in theta_place(d, f).select("did", "uid", "reason").collect()}
