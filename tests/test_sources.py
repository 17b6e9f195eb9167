import gzip
import io
import json
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions import device, net
from tidemark.sources import captures, engines, feeds


def _lines(spark, rows):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)], "pos long, value string")


CONN = {"ts": 1700000000.1234565, "uid": "C1", "id.orig_h": "10.0.0.1", "id.orig_p": 1, "id.resp_h": "10.0.0.2", "id.resp_p": 2, "proto": "TCP", "duration": 1.5}


def test_conn_and_ssl(spark):
    other = {k: v for k, v in CONN.items() if k != "duration"} | {"uid": "C2"}
    ssl = [{"uid": "C1"}, {"uid": "C1", "server_name": "first"}, {"uid": "C1", "server_name": "second", "ja4": "j"}, {"uid": "zz", "ja4": "x"}]
    got = {r["uid"]: r for r in engines.flows(_lines(spark, [CONN, other]), _lines(spark, ssl)).collect()}
    assert (got["C1"]["proto"], got["C1"]["server_name"], got["C1"]["ja4"]) == ("tcp", "first", "j") and set(got) == {"C1", "C2"}
    assert got["C2"]["ts_last_us"] == got["C2"]["ts_first_us"] == round(CONN["ts"] * 1e6) and got["C1"]["ts_last_us"] == round((CONN["ts"] + 1.5) * 1e6)
    assert engines.flows(_lines(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [[CONN, CONN], [{k: v for k, v in CONN.items() if k != "id.resp_h"}], ["{not json"]])
def test_conn_faults_are_failures(spark, rows):
    with pytest.raises(Exception):
        engines.flows(_lines(spark, rows)).collect()


def test_eve(spark):
    alert = {"event_type": "alert", "timestamp": "2023-11-14T22:13:20.5+0530", "src_ip": "2001:0db8::0001", "dest_ip": "10.0.0.2", "icmp_type": 8, "icmp_code": 3, "proto": "IPv6-ICMP", "direction": "odd", "alert": {"signature_id": 7, "signature": "x", "metadata": {"b": ["2", "1"], "a": ["z"]}}}
    quiet = alert | {"alert": {"signature_id": 8, "signature": "y"}}
    stats = lambda *n: {"event_type": "stats", "stats": {"detect": {"engines": [{"rules_loaded": x, "rules_failed": 0, "rules_skipped": 1} for x in n]}}}
    ev = engines.eve(_lines(spark, [stats(5), alert, quiet, stats(9, 4), stats(), {"event_type": "flow"}]))
    index = spark.createDataFrame([(7, "s", "signature"), (8, "t", "identify")], "sid long, source string, source_class string")
    none = spark.createDataFrame([], "sid long, classtype string")
    (r,) = engines.detections(ev, index, none).collect()
    assert (r["src_ip"], r["src_port"], r["dst_port"], r["proto"], r["direction"], r["metadata"], r["rev"]) == ("2001:db8::1", 8, 3, "icmp", "unknown", ["a z", "b 1", "b 2"], 0)
    assert r["ts_us"] == 1_700_000_000_500_000 - int(5.5 * 3600 * 1e6)
    assert tuple(engines.alert_counts(ev, index).first()) == (2, 1, 4) and tuple(engines.rules_loaded(ev).first()) == (9, 0, 1)
    with pytest.raises(Exception, match="no source has sid"):
        engines.detections(ev, index.where("sid = 8"), none).collect()
    with pytest.raises(Exception, match="no offset"):
        engines.detections(engines.eve(_lines(spark, [alert | {"timestamp": "2023-11-14T22:13:20"}])), index, none).collect()


def test_engine_texts(spark):
    log = _lines(spark, ["3 rules successfully loaded, 1 rules failed, 0 rules skipped", "noise", "8 rules successfully loaded, 0 rules failed, 2 rules skipped"])
    assert tuple(engines.rules_loaded_log(log).first()) == (8, 0, 2)
    tsv = _lines(spark, ["#fields\ta", "1\tx\ty", "", "2\tz\tw"])
    assert [r["value"] for r in engines.without_first_column(tsv).collect()] == ["x\ty", "z\tw"]
    c = spark.createDataFrame([(None, 5), (0, 5), (4, 5), (5, 5)], "a int, b int").select(engines.ruleset_check(F.col("a"), F.col("b")))
    assert [r[0] for r in c.collect()] == ["failure: no count", "failure: no rule loaded", "warning: 4 of 5 rules loaded (80.0%)", None]


def pcap(packets, end="<", nano=False, version=2):
    magic = {("<", False): 0xA1B2C3D4, ("<", True): 0xA1B23C4D}[("<", nano)]
    out = struct.pack(end + "IHHiIII", magic, version, 4, 0, 0, 65535, 1)
    return out + b"".join(struct.pack(end + "IIII", s, f, len(b), len(b)) + b for s, f, b in packets)


def block(kind, body):
    body += b"\0" * (-len(body) % 4)
    return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)


def pcapng(*blocks):
    return block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + b"".join(blocks)


IDB = lambda link=1, snap=100: block(1, struct.pack("<HHI", link, 0, snap))
EPB = lambda i=0, us=5, data=b"abcd": block(6, struct.pack("<IIIII", i, us >> 32, us & 0xFFFFFFFF, len(data), len(data)) + data)


def test_captures(spark, tmp_path):
    two = [(1, 5, b"abc"), (2, 7, b"d")]
    files = {
        "a": pcap(two), "b": pcap(two, end=">"), "c": gzip.compress(pcap([(1, 5000, b"x")], nano=True)), "d": pcap(two)[:-1], "e": pcap([]), "f": pcap(two, version=3), "g": b"nonsense!",
        "h": pcapng(IDB(), IDB(101, 200), EPB(1), EPB(1, 9), EPB(0, 7)), "i": pcapng(EPB(0)), "j": pcapng(IDB(), EPB())[:-2],
    }
    for n, b in files.items():
        (tmp_path / n).write_bytes(b)
    rows = captures.read(spark, str(tmp_path))
    got = {r["path"][-1]: r for r in captures.facts(rows).collect()}
    assert [(got[n]["packets"], got[n]["input_status"], got[n]["first_us"], got[n]["last_us"]) for n in "abc"] == [(2, "complete", 1000005, 2000007)] * 2 + [(1, "complete", 1000005, 1000005)]
    assert (got["d"]["packets"], got["d"]["input_status"], got["d"]["truncated_at"]) == (1, "partial", 24 + 19)
    assert (got["e"]["fault"], got["f"]["fault"], got["g"]["fault"], got["i"]["fault"]) == ("no packet", "version 3", "not a capture", "interface 0 is not defined")
    assert (got["h"]["link_type_name"], got["h"]["snaplens"], got["h"]["discarded_packets"], got["h"]["first_us"], got["h"]["last_us"]) == ("RAW", [200], 1, 5, 7)
    assert got["j"]["fault"] == "no packet" and got["j"]["truncated_at"] is not None
    d = {r["path"][-1]: r["container"] for r in captures.digests(spark, str(tmp_path)).collect()}
    assert (d["a"], d["b"], d["c"], d["g"], d["h"]) == ("pcap", "pcap", "gzip", None, "pcapng")


def test_feeds(spark):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as tar:
        for n, b in (("z/b.rules", b"two"), ("a.rules", b"one\n"), ("list.txt", b"x")):
            info = tarfile.TarInfo(n)
            info.size = len(b)
            tar.addfile(info, io.BytesIO(b))
    df = spark.createDataFrame([("t", bytearray(gzip.compress(buffer.getvalue()))), ("p", bytearray("é\nq".encode()))], "source string, content binary")
    got = [tuple(r) for r in feeds.rule_lines(df).orderBy("source", "line_no").collect()]
    assert got == [("p", 1, "é"), ("p", 2, "q"), ("t", 1, "one"), ("t", 2, "two")]


GOOD = 'name="n"\nurl="u"\nlicence="MIT"\nsource_class="signature"\nadmission_basis="wholesale"\n'


def test_registry(spark):
    df, _ = feeds.registry(spark, f'﻿[[source]]\n{GOOD}exclude_classtypes=["b"]\n[admission]\nexclude_classtypes=["a"]\n')
    assert (df.first()["exclude_classtypes"], df.first()["enabled"]) == (["a", "b"], True)
    for bad in (f"[[source]]\n{GOOD}x=1\n", "[[source]]\nname='n'\n", f"[[source]]\n{GOOD}[[source]]\n{GOOD.replace(chr(34) + 'n' + chr(34), chr(34) + 'N' + chr(34))}", "[admission]\ny=1\n", "[[source]]\n" + GOOD.replace("signature", "odd")):
        with pytest.raises(feeds.BadFeed):
            feeds.registry(spark, bad)


def test_device_xml(spark, tmp_path):
    entry = "<entry><receive_time>2026/08/12 10:11:12</receive_time><subtype>{}</subtype><src>10.0.0.1</src><dst>10.0.0.2</dst><sport>1</sport><dport>x</dport><proto>tcp</proto><threatid>{}</threatid><direction>client-to-server</direction></entry>"
    (tmp_path / "log.xml").write_text("<response><result><log><logs>" + entry.format("vulnerability", "Bad thing(91535)") + entry.format("url", "(9999)") + "</logs></log></result></response>")
    df = feeds.threat_log(spark, str(tmp_path / "log.xml"))
    c = F.col
    got = [tuple(r) for r in df.select(device.admits(c("subtype")), device.threat_id(c("threatid"), c("tid")), device.threat_name(c("threatid")), device.port(c("dport")), device.direction(c("direction"))).orderBy(F.desc("subtype")).collect()]
    assert got == [(True, 91535, "Bad thing", 0, "to_server"), (False, 9999, "(9999)", 0, "to_server")]
    info = spark.createDataFrame([("<r><system><hostname>h</hostname><threat-version>0</threat-version></system></r>",)], "value string")
    assert feeds.system_info(info).first()["has_threat_content"] is False


def test_index_and_workflows(spark):
    doc = lambda s: spark.createDataFrame([(json.dumps({"schema": s, "sources": {"a": [1, 2]}, "address_indicator": [2]}),)], "value string")
    assert {tuple(r) for r in feeds.sid_index(doc(3)).collect()} == {(1, "a", False), (2, "a", True)} and {r[2] for r in feeds.sid_index(doc(2)).collect()} == {None}
    with pytest.raises(Exception):
        feeds.sid_index(doc(4)).collect()
    run = {"created_at": "2026-08-01T00:00:00Z", "conclusion": "success"}
    for shape in ([run], {"workflow_runs": [run]}):
        assert feeds.workflow_runs(spark.createDataFrame([(json.dumps(shape),)], "value string")).first()["conclusion"] == "success"


def test_addresses(spark):
    ips = ["2001:0DB8:0:0::1", "10.0.0.1", "not:an:ip", None, "::ffff:10.0.0.1"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(ips)], "i int, x string").orderBy("i").select(net.compressed("x")).collect()]
    assert got[:4] == ["2001:db8::1", "10.0.0.1", "not:an:ip", None]
