import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import constraints, corpus, ddl, documents, gates, store

T0 = 1_755_691_200_000_000
DAY = 86_400_000_000


def test_authoritative_runs(spark):
    rows = [
        ("cap-a", "run-a1", T0, [2]), ("cap-a", "run-a2", T0, [2]), ("cap-b", "run-b-old", T0, [2]), ("cap-b", "run-b-new", T0 + DAY, [2]),
        ("cap-c", "run-c-old", T0, [2]), ("cap-c", "run-c-new", T0 + DAY, [2]), ("cap-d", "run-d", T0, [1]), ("cap-e", "run-e", None, [1, 2]), ("cap-f", "run-f", T0, []),
    ]
    runs = spark.createDataFrame(rows, "capture_sha256 string, run_id string, finished_us long, tiers_attested array<int>")
    out = spark.createDataFrame([("run-c-new", "x")], "run_id string, reason string")
    got = {tuple(r) for r in store.authoritative(runs, out).collect()}
    assert got == {("cap-a", 2, "run-a2"), ("cap-b", 2, "run-b-new"), ("cap-c", 2, "run-c-old"), ("cap-d", 1, "run-d"), ("cap-e", 1, "run-e"), ("cap-e", 2, "run-e")}


def test_attestation_needs_evidence(spark):
    rows = [("both", 10, 10, False), ("both", 9, 10, False), ("offline", 0, 0, False), ("offline", None, 10, None), ("replay", 10, 10, True), ("replay", None, None, None)]
    df = spark.createDataFrame(rows, "mode string, rules_loaded int, total_admitted int, device_failed boolean")
    assert [r["tiers_attested"] for r in store.attest(df).collect()] == [[1, 2], [1], [], [], [], [1]]


def test_times_round_half_to_even(spark):
    x = [0.0000005, 0.0000015, 1700000005.1234565, 2.5e-6]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "v double").select(store.micros(F.col("v"))).collect()]
    assert got == [round(v * 1e6) for v in x]
    assert spark.range(1).select(store.iso(F.lit(1_700_000_000_000_001))).first()[0] == "2023-11-14T22:13:20.000001Z"


def test_flow_key_ignores_orientation_and_uid(spark):
    rows = [("u1", "TCP", "10.0.0.9", 80, "10.0.0.10", 5), ("u2", "tcp", "10.0.0.10", 5, "10.0.0.9", 80), ("u3", "tcp", "10.0.0.9", 81, "10.0.0.10", 5)]
    df = spark.createDataFrame([(*r, T0) for r in rows], "uid string, proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_first_us long")
    a, b, c = (r[0] for r in df.select(store.flow_key(F.lit("cap"), F.lit(6))).collect())
    assert a == b != c and len(a) == 16


def test_compose_keeps_only_authoritative_tiers(spark):
    rows = [("r1", "c", "k", 1, "s", 5, "malicious"), ("r1", "c", "k", 2, "s", 6, "malicious"), ("r2", "c", "k", 2, "s", 7, "benign")]
    df = spark.createDataFrame(rows, "run_id string, capture_sha256 string, flow_key string, tier int, source string, sid long, value string")
    chosen = spark.createDataFrame([("c", 1, "r1"), ("c", 2, "r2")], "capture_sha256 string, tier int, run_id string")
    r = store.compose(df, chosen).first()
    assert (r["best_tier"], r["sids"], r["runs"], r["conflict"]) == (1, [5, 7], 2, True)


def test_load_is_idempotent_and_runs_come_last(spark, tmp_path):
    tables = {n: spark.range(3).withColumn("x", F.lit(n)) for n in store.TABLES}
    runs = spark.range(1).select(F.lit("cap").alias("capture_sha256"))
    spark.range(9).write.parquet(f"{tmp_path}/captures/run_id=a")  # left by a run that was cut off
    assert store.load(spark, str(tmp_path), "a", tables, runs) and not store.load(spark, str(tmp_path), "a", tables, runs)
    assert store.load(spark, str(tmp_path), "b", tables, runs)
    assert spark.read.parquet(f"{tmp_path}/captures").groupBy("run_id").count().orderBy("run_id").collect() == [("a", 3), ("b", 3)]
    assert sorted(r["run_id"] for r in spark.read.parquet(f"{tmp_path}/runs").collect()) == ["a", "b"]


def test_uri_faults(spark):
    uris = ["gs://b/o", "", None, "s3://b/o", "gs:///o", "gs://b/", "gs://b", "gs://b/o\n", "gs://b/" + "x" * 2000]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in uris], "u string").select(store.uri_fault(F.col("u"))).collect()]
    assert got == [None, "empty", "empty", "scheme", "bucket", "object", "object", "control character", "long"]


def _table(*fields, **more):
    return ddl.Table("t", T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields]), **more)


def test_schema_differences_and_plan():
    L, S = T.LongType(), T.StringType()
    nest = lambda *names: T.ArrayType(T.StructType([T.StructField(n, S) for n in names]))
    want = _table(("a", L, True), ("b", S, True), ("n", nest("x", "y"), True))
    assert ddl.verify([want], {"t": want}) == ddl.OK and ddl.verify([want], {}) == ddl.DRIFT
    statements, rebuild = ddl.patch_plan([want], {"t": _table(("a", L, True), ("n", nest("x", "y"), True))})
    assert statements == ["ALTER TABLE t ADD COLUMNS (b string)"] and not rebuild
    for live in (_table(("a", S, True), ("b", S, True), ("n", nest("x", "y"), True)), _table(("b", S, True), ("a", L, True), ("n", nest("x", "y"), True)), _table(("a", L, True), ("b", S, True), ("n", nest("y", "x"), True)), _table(("a", L, True), ("b", S, True), ("n", nest("x", "y"), True), ("z", S, True))):
        assert ddl.patch_plan([want], {"t": live})[1] and ddl.verify([want], {"t": live}) == ddl.REBUILD
    with pytest.raises(ddl.Undeclarable):
        _table(("a", L, True), partition="a")
    with pytest.raises(ddl.Undeclarable):
        ddl.view("SELECT {dataset}", "x; drop")


def test_prevalence_and_gates(spark):
    p = lambda *a: spark.range(1).select(corpus.prevalence(*[F.lit(x) for x in a])).first()[0]
    assert [p(1, 9, 1), p(6, 9, 1), p(5, 9, 1), p(9, 9, 2), p(0, 0, 1)] == ["one", "EVERY", "", "", ""]
    seen = spark.createDataFrame([("s", 1, "d", 5), ("s", 1, "i", 5), ("s", 2, "d", 50), ("s", 3, "d", 1)], "source string, sid long, label_basis string, entries long")
    allowed = spark.createDataFrame([("s", 1, "d", 1), ("s", 2, "d", 1), ("s", 9, "d", 1)], "source string, sid long, label_basis string, count_when_measured long")
    assert {tuple(r) for r in corpus.review(seen, allowed).collect()} == {("s", 1, "i", "offender"), ("s", 2, "d", "above ceiling"), ("s", 3, "d", "offender"), ("s", 9, "d", "stale")}
    builds = spark.createDataFrame([("w", "success", T0), ("w", "failure", T0 + DAY), ("x", "failure", T0)], "workflow string, conclusion string, created_us long")
    assert {(r["workflow"], r["stale"]) for r in corpus.liveness(builds, T0 + 3 * DAY, 3.0).collect()} == {("w", False), ("x", True)}


def test_run_differences(spark):
    rows = lambda x: spark.createDataFrame(x, "name string, pos int, record string")
    a, b = rows([("f", 0, "x"), ("f", 1, "y"), ("g", 0, "z")]), rows([("f", 0, "x"), ("f", 1, "q"), ("f", 2, "r"), ("h", 0, "z")])
    assert {tuple(r) for r in corpus.differences(a, b).collect()} == {("f", "differs", 1), ("g", "only left", 0), ("h", "only right", 0)}
    assert corpus.bag_differences(a, a.orderBy(F.desc("pos"))).count() == 0 and corpus.bag_differences(a, b).count() == 5


def test_documents(spark, tmp_path):
    text = documents.render({"b": [1], "a": "é"})
    assert text == '{\n  "a": "é",\n  "b": [\n    1\n  ]\n}\n'
    with pytest.raises(ValueError):
        documents.render({"x": float("nan")})
    documents.write_atomic(str(tmp_path / "labels.json"), text)
    assert (tmp_path / "labels.json").read_text() == text and len(list(tmp_path.iterdir())) == 1
    doc = {"run": {"started_at": 1, "mode": "both", "input": {"path": "p", "sha256": "s"}}}
    assert documents.canonical_document(doc) == {"run": {"mode": "both", "input": {"sha256": "s"}}}
    lines = spark.createDataFrame([('{"flow_id":1,"b":2,"a":{"c":1},"flow":{"reason":"x","k":1}}',), ('{"event_type":"stats"}',)], "value string")
    assert [r[0] for r in documents.canonical_events(lines).collect()] == ['{"a": {"c": 1}, "b": 2, "flow": {"k": 1}}']
    with pytest.raises(Exception, match="licences conflict"):
        documents.notice(spark.createDataFrame([("s", "MIT"), ("s", "GPL")], "source string, licence string")).collect()


def test_constraints(spark):
    df = spark.createDataFrame([(1, "both", "partial"), (2, "x", None)], "id int, mode string, input_status string")
    found = constraints.enumerations(df, "id")
    assert [tuple(r) for r in found.collect()] == [(2, "mode is unknown")]
    with pytest.raises(constraints.Violated):
        constraints.demand(found)


def _documents(spark, rows):
    entry = "array<struct<tier: int, source: string, sid: bigint, rev: bigint, direction: string>>"
    return spark.createDataFrame(rows, f"run_id string, capture_sha256 string, flow_key string, labels array<struct<name: string, value: string, tier: int, sids: array<bigint>>>, sources {entry}")


def test_merge_unions_entries_and_takes_the_least_tier(spark):
    one = [("verdict", "malicious", 1, [5, 9]), ("threat-name", "x", 1, [5])]
    two = [("verdict", "malicious", 2, [7])]
    rows = [
        ("r1", "c", "k", one, [(1, "b", 9, 1, "to_server"), (1, "a", 5, 1, "to_server"), (2, "z", 1, 1, "to_server")]),
        ("r2", "c", "k", two, [(2, "s", 7, 1, "to_client"), (2, "s", 7, 1, "to_client")]), ("r2", "c", "only-tier-1", [("verdict", "malicious", 1, [3])], [(1, "s", 3, 1, "to_client")]),
    ]
    chosen = spark.createDataFrame([("c", 1, "r1"), ("c", 2, "r2")], "capture_sha256 string, tier int, run_id string")
    (r,) = store.merge(_documents(spark, rows), chosen).collect()
    assert [tuple(s)[:3] for s in r["sources"]] == [(1, "a", 5), (1, "b", 9), (2, "s", 7), (2, "s", 7)]
    assert [tuple(x) for x in r["labels"]] == [("threat-name", "x", 1, [5]), ("verdict", "malicious", 1, [5, 7, 9])]
    assert (r["best_tier"], r["runs"], r["conflicts"]) == (1, ["r1", "r2"], [])


def test_merge_refuses_to_choose(spark):
    rows = [("r1", "c", "k", [("verdict", "malicious", 1, [5])], [(1, "a", 5, 1, "x")]), ("r2", "c", "k", [("verdict", "other", 2, [6])], [(2, "a", 6, 1, "x")])]
    chosen = spark.createDataFrame([("c", 1, "r1"), ("c", 2, "r2")], "capture_sha256 string, tier int, run_id string")
    with pytest.raises(Exception, match="tiers disagree on verdict of flow k"):
        store.merge(_documents(spark, rows), chosen).collect()
    assert store.merge(_documents(spark, rows), chosen, strict=False).first()["conflicts"] == ["verdict"]


def test_a_refused_run_leaves_no_marker(spark, tmp_path):
    flows = spark.createDataFrame([("a", "tcp", "gs://b/o"), ("b", "esp", "gs://b/o"), ("c", None, "gs://b/o"), ("d", "udp", None)], "uid string, proto string, uri string")
    tables = {"captures": spark.range(1), "unmatched": spark.range(1), "flow_labels": flows}
    runs = spark.range(1).select(F.lit("cap").alias("capture_sha256"))
    with pytest.raises(gates.Refused, match="1 without origin"):
        store.load(spark, str(tmp_path), "a", tables, runs, {"flow_labels": store.flow_gates()})
    assert not (tmp_path / "runs").exists()
    assert store.load(spark, str(tmp_path), "a", tables, runs, {"flow_labels": store.flow_gates(allow_missing_origin=True)})
    assert spark.read.parquet(f"{tmp_path}/runs").first()["refused"] == {"flow_labels: unsupported transport": 2, "flow_labels: without origin": 1}
    assert sorted(r["uid"] for r in spark.read.parquet(f"{tmp_path}/flow_labels").collect()) == ["a", "d"]


def test_admission_that_does_not_balance_raises(spark):
    from tidemark.operators import rules

    zero = {v: 0 for v in rules.COUNTED}
    good = spark.createDataFrame([{"source": "s", "fetched": 3, "admitted": 2, **zero, "marker": 1}])
    assert rules.balanced(good).count() == 1
    with pytest.raises(Exception, match="does not balance"):
        rules.balanced(good.withColumn("fetched", F.lit(4))).select("source").collect()


def test_unsound_runs(spark):
    rows = [("a", "labelled", 5, 5, "complete"), ("b", "labelled", 4, 5, "partial"), ("c", "labelled", None, None, "complete"), ("d", "labelled", 5, 5, "partial")]
    df = spark.createDataFrame(rows, "run_id string, state string, rules_loaded int, total_admitted int, input_status string")
    assert {tuple(r) for r in corpus.unsound(df).collect()} == {("b", "loaded 4 of 5 rules"), ("c", "loaded an unknown number of unknown rules"), ("d", "input is partial")}
    with pytest.raises(Exception, match="run a wrote no labels: killed"):
        corpus.unsound(df.withColumn("state", F.lit("killed"))).collect()
