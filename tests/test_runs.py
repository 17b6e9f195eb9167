import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import constraints, corpus, rules
from tidemark.sources import runs


def test_run_folders(spark, tmp_path):
    entry = {"source": "s", "sid": 1, "label_basis": "direct", "classtype": None}
    doc = {"run": {"mode": "both", "counts": {"rules_loaded": 5}, "input": {"input_status": "complete"}, "warnings": ["a: b"]}, "labels": [{"flow": {"uid": "u"}, "sources": [entry, entry]}]}
    for name, files in {"a": {"labels.json": doc, "run.json": {"run": {}}}, "b": {"run.json": {"run": {"mode": "replay"}}}, "c": {"other.json": {}}}.items():
        (tmp_path / name).mkdir()
        for f, d in files.items():
            (tmp_path / name / f).write_text(json.dumps(d))
    df = runs.documents(spark, str(tmp_path), spark.createDataFrame([(x,) for x in "abcd"], "folder string"))
    got = {r["folder"]: (r["state"], r["run"]["mode"] if r["run"] else None) for r in df.collect()}
    assert got == {"a": ("labelled", "both"), "b": ("failed", "replay"), "c": ("killed", None), "d": ("killed", None)}
    (t,) = corpus.totals(runs.entries(df)).collect()
    assert (t["source"], t["entries"], t["runs"]) == ("s", 2, 1)


def test_toolchain(spark):
    one = lambda text: [tuple(r) for r in runs.toolchain(spark.createDataFrame([(text,)], "value string"), "a", "b").collect()]
    assert one('{"a": "1.2.3", "b": "not a version!"}') == [("a", "1.2.3", None), ("b", None, "unusable version of b")]
    assert one("{}")[0] == ("a", None, "no version of a") and one("broken")[0][1:] == (None, "the manifest can't be read")


def test_snapshots_are_verified(spark):
    files = spark.createDataFrame([("rules.rules", bytearray(b"x"))], "path string, content binary")
    good = rules.content_id_of({"rules.rules": b"x"})
    assert runs.verified(files, good).count() == 1 and constraints.identifiers(spark.createDataFrame([(good,), ("XYZ",), (None,)], "i string"), "i").count() == 2
    with pytest.raises(ValueError):
        runs.verified(files, "0" * 16)


def test_policy_values(spark):
    df = spark.createDataFrame([("👁", "bad-unknown"), ("👁👀", "no spaces"), ("x", ""), (None, None), ("🏴‍", "a.b")], "m string, c string")
    assert [tuple(r) for r in df.select(runs.valid_marker(F.col("m")), runs.valid_classtype(F.col("c"))).collect()] == [(True, True), (False, False), (False, False), (False, False), (True, True)]


def test_dataset_files(spark):
    lines = spark.createDataFrame([("s", "alert x (dataset:isset, a, type string, load one.lst; sid:1;)"), ("s", "alert x (dataset:isset,b, load two.lst, save z; sid:2;)"), ("s", "no data")], "source string, text string")
    files = rules.dataset_files(lines)
    assert {r["file"] for r in files.collect()} == {"one.lst", "two.lst"}
    have = spark.createDataFrame([("d1", "one.lst"), ("d2", "two.lst")], "folder string, file string")
    assert {(r["file"], r["folder"]) for r in rules.resolved(files, have).collect()} == {("one.lst", "d1"), ("two.lst", "d2")}
    for bad in (have.where("folder = 'd1'"), have.unionByName(spark.createDataFrame([("d3", "one.lst")], "folder string, file string"))):
        with pytest.raises(Exception, match="data file in"):
            rules.resolved(files, bad).collect()


def test_nothing_admitted(spark):
    df = spark.createDataFrame([("a", 0, 0, 0, 0, 0), ("b", 3, 0, 3, 0, 0), ("c", 3, 0, 0, 3, 0), ("d", 3, 0, 1, 1, 0), ("e", 3, 2, 1, 0, 1)], "source string, fetched int, admitted int, no_confidence int, unloadable int, ja4_admitted int")
    got = {r["source"]: r["message"] for r in rules.nothing_admitted(df).collect()}
    assert got == {"a": "the feed has no active rule", "b": "no rule has a confidence", "c": "no rule can be loaded", "d": "every rule was excluded"} and tuple(rules.totals(df).first()) == (2, 1)


def test_stamps_placement_and_clocks(spark):
    df = spark.createDataFrame([("2026-08-12T10:11:12.000000Z", "2026-08-12 10:11:12")], "a string, b string")
    assert [r["name"] for r in constraints.stamps(df, "a", "b").collect()] == ["b"]
    placed = spark.createDataFrame([(1, "u", None), (2, None, "no_flow_match"), (3, "u", "x"), (4, None, None)], "did int, uid string, reason string")
    assert [r["did"] for r in constraints.placement(placed).orderBy("did").collect()] == [3, 4]
    assert spark.range(1).select(constraints.skew(F.lit(0), F.lit(30_000_000)), constraints.skew(F.lit(0), F.lit(30_000_001))).first() == (False, True)


def test_entries_are_traceable(spark):
    rows = [(1, 1, "a", "a", "x", "MIT", "signature", "0123456789abcdef"), (2, 2, "a", "b", "x", "MIT", "signature", "0123456789abcdef"), (3, 2, "a", "a", "", "MIT", "identify", "abc")]
    df = spark.createDataFrame(rows, "did int, tier int, source string, admitted_source string, threat string, licence string, source_class string, snapshot_id string")
    assert {tuple(r) for r in constraints.source_entries(df).collect()} == {(2, "terms of another source"), (3, "no threat"), (3, "source may not label"), (3, "no snapshot id")}


def test_files_that_needn_t_be_equal(spark):
    names = ["suricata/suricata.log", "zeek/packet_filter.log", ".run.json.partial", "run.json", "zeek/conn.log"]
    df = spark.createDataFrame([(n, 1, "x") for n in names], "name string, pos int, record string")
    assert {r["name"] for r in corpus.differences(df, df.withColumn("record", F.lit("y"))).collect()} == {"run.json", "zeek/conn.log"}


def test_times_that_no_calendar_has(spark):
    from tidemark.operators import store

    df = spark.createDataFrame([(store.FIRST_US,), (None,), (store.LAST_US,)], "x long")
    assert [r[0] for r in df.select(store.iso(F.col("x"))).collect()] == ["0001-01-01T00:00:00.000000Z", None, "9999-12-31T23:59:59.999999Z"]
    with pytest.raises(Exception, match="no UTC time"):
        df.select(store.iso(F.col("x") + 1)).collect()
