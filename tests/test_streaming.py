import json

from tidemark.streaming import live

ALERT = {"event_type": "alert", "timestamp": "2026-08-12T10:11:12Z", "direction": "to_server"}


def test_alerts_by_window(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [ALERT, ALERT, ALERT | {"timestamp": "2026-08-12T10:31:12+00:00"}, {"event_type": "flow"}]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    q = live.alerts_per_window(live.events(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("alerts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["alerts"] for r in spark.table("alerts").collect()) == [1, 2]


def test_batches_are_placed(spark, tmp_path):
    schema = "did long, proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_us long"
    spark.createDataFrame([(1, "tcp", "a", 1, "b", 2, 5), (2, "tcp", "b", 2, "a", 9, 5)], schema).write.parquet(str(tmp_path / "d"))
    flows = spark.createDataFrame([("u", "tcp", "b", 2, "a", 1, 0, 9)], "uid string, proto string, src_ip string, src_port int, dst_ip string, dst_port int, ts_first_us long, ts_last_us long")
    out: dict = {}
    q = live.place_batches(spark.readStream.schema(schema).parquet(str(tmp_path / "d")), flows, lambda df, n: out.__setitem__(n, {r["did"]: r["uid"] or r["reason"] for r in df.collect()}), str(tmp_path / "c"))
    q.awaitTermination(120)
    assert {k: v for d in out.values() for k, v in d.items()} == {1: "u", 2: "no_flow_match"}
