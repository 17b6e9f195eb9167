"""Snapshots on a file system, feed archives, nested headers, replay windows, first-seen order."""

import gzip
import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents, replay, rules, snapshots
from tidemark.sources import feeds

TEXT = 'alert tcp any any -> any any (msg:"x"; content:"y"; metadata: confidence High, signature_severity Major; sid:{}; rev:1;)'


def _judged(spark, sids):
    return rules.judge(spark.createDataFrame([(i, f"s{k % 2}", TEXT.format(k)) for i, k in enumerate(sids)], "line_no long, source string, text string"))


def _data(spark, *rows):
    return spark.createDataFrame([(s, n, bytearray(c)) for s, n, c in rows], "source string, name string, content binary")


def test_commit_reuse_and_damage(spark, tmp_path):
    root, j = str(tmp_path / "snaps"), _judged(spark, range(1, 40))
    big = random.Random(1).randbytes(100_000)
    data = _data(spark, ("s0", "a.lst", b""), ("s1", "b.lst", big))
    name, fresh = snapshots.write(spark, root, snapshots.components(j, data), rules.admission(j), "2026-01-01T00:00:00Z")
    lines = "".join(f"{TEXT.format(k)}\n" for s in (0, 1) for k in range(1, 40) if k % 2 == s).encode()
    index = "".join(json.dumps({"schema": 3, "sources": {f"s{s}": [k for k in range(1, 40) if k % 2 == s]}, "address_indicator": []}, separators=(",", ":")) + "\n" for s in (0, 1)).encode()
    assert fresh and name == rules.content_id_of({"rules.rules": lines, "sid_index.json": index, "data/s0/a.lst": b"", "data/s1/b.lst": big})
    before = sorted(p.stat().st_mtime_ns for p in (tmp_path / "snaps" / name).rglob("*"))
    assert snapshots.write(spark, root, snapshots.components(j.repartition(7), data), rules.admission(j), "2027-01-01T00:00:00Z") == (name, False)
    assert before == sorted(p.stat().st_mtime_ns for p in (tmp_path / "snaps" / name).rglob("*")) and len(list((tmp_path / "snaps").iterdir())) == 1
    assert snapshots.load(spark, root)[0] == name and {r["sid"] for r in snapshots.index(snapshots.load(spark, root, name)[1]).collect()} == set(range(1, 40))
    other, _ = snapshots.write(spark, root, snapshots.components(_judged(spark, [5])), rules.admission(_judged(spark, [5])), "2026-03-01T00:00:00Z")
    assert snapshots.load(spark, root)[0] == other
    (part,) = [p for p in (tmp_path / "snaps" / other / "components").glob("part-*") if p.stat().st_size > 1200][:1]
    spark.read.parquet(str(part)).withColumn("content", F.when(F.col("path") == "rules.rules", F.encode(F.lit("else\n"), "utf-8")).otherwise(F.col("content"))).write.parquet(f"{root}/x")
    (new,) = (tmp_path / "snaps" / "x").glob("part-*")
    part.write_bytes(new.read_bytes())
    (part.parent / f".{part.name}.crc").unlink()
    for again in (lambda: snapshots.load(spark, root, other), lambda: snapshots.write(spark, root, snapshots.components(_judged(spark, [5])), rules.admission(_judged(spark, [5])), "2026-04-01T00:00:00Z")):
        with pytest.raises(snapshots.Damaged, match="has the content of"):
            again()


def test_manifests_that_lie_are_skipped_aloud(spark, tmp_path):
    root, j = str(tmp_path), _judged(spark, [1, 2, 3])
    name, _ = snapshots.write(spark, root, snapshots.components(j), rules.admission(j), "2026-01-01T00:00:00Z")
    good = json.loads((tmp_path / name / "manifest.json").read_text())
    for folder, text in {"a" * 16: "{", "b" * 16: json.dumps(good), "c" * 16: json.dumps(good | {"snapshot_id": "c" * 16, "manifest_version": 9}), "d" * 16: json.dumps(good | {"snapshot_id": "d" * 16, "total_admitted": 7})}.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "manifest.json").write_text(text)
    own, _, warnings = snapshots.load(spark, root)
    assert own == name and [w.split(": ")[1] for w in warnings] == ["not a JSON object", "claims to be another snapshot", "another format version", "totals don't match the sources"]
    with pytest.raises(snapshots.Damaged, match="no snapshot"):
        snapshots.load(spark, root, "e" * 16)


def test_what_a_snapshot_refuses(spark, tmp_path):
    j = _judged(spark, [1, 2])
    for data, said in ((("s0", "../x", b"1"), "not a plain file name"), (("s0", ".x", b"1"), "not a plain file name"), (("s9", "x", b"1"), "source without rules")):
        with pytest.raises(Exception, match=said):
            snapshots.components(j, _data(spark, data)).collect()
    with pytest.raises(snapshots.Damaged, match="without rules"):
        snapshots.write(spark, str(tmp_path), snapshots.components(j.where("false")), rules.admission(j), "2026-01-01T00:00:00Z")
    assert list(tmp_path.iterdir()) == []


def _tar(*files, gz=True):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, content in files:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type, info.linkname = tarfile.SYMTYPE, "elsewhere"
                tar.addfile(info)
            else:
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
    return gzip.compress(out.getvalue()) if gz else out.getvalue()


def test_feed_members(spark):
    feed = _tar(("z/b.rules", b"two\nthree"), ("a.rules", b"one\n"), ("d/list.lst", b"x"), ("c.rules", None))
    df = spark.createDataFrame([("t", bytearray(feed)), ("p", bytearray(b"only"))], "source string, content binary")
    got = {(r["source"], r["name"], r["kind"], r["bytes"]) for r in feeds.contents(df).collect()}
    assert got == {("t", "z/b.rules", "rules", 9), ("t", "a.rules", "rules", 4), ("t", "list.lst", "data", 1), ("p", "feed.rules", "rules", 4)}
    assert [tuple(r) for r in feeds.rule_lines(df).orderBy("source", "line_no").collect()] == [("p", 1, "only"), ("t", 1, "one"), ("t", 2, "two"), ("t", 3, "three")]


@pytest.mark.parametrize(("feed", "said"), [
    (b"", "empty"), (_tar(("x.lst", b"1")), "without rules"), (_tar(("a/x.lst", b"1"), ("b/x.lst", b"2"), ("r.rules", b"")), "two companion files"), (gzip.compress(b"a" * 999)[:-9], "not readable"),
    (_tar(("r.rules", b"r" * 5000)), "r.rules: too large"), (gzip.compress(b"a" * 99_999), "too large"), (_tar(*[(f"{k}.rules", b"r" * 3000) for k in range(9)]), "too large"),
])
def test_feeds_that_are_refused(feed, said):
    with pytest.raises(feeds.BadFeed, match=said):
        list(feeds.members(feed, largest=20_000, member=4000))


def _negates(header):
    """Each ``!`` with what it applies to, read character by character."""
    for i, c in enumerate(header):
        if c == "!":
            rest, depth, end = header[i + 1 :], 0, 0
            if rest[:1] == "[":
                for end, d in enumerate(rest):
                    depth += (d == "[") - (d == "]")
                    if not depth:
                        break
                term = rest[: end + 1]
            else:
                term = rest[: next((k for k, d in enumerate(rest) if d in ",[] \t"), len(rest))]
            for k in range(len(term)):
                if term.startswith("$HOME_NET", k) and not (term[k + 9 : k + 10].isalnum() or term[k + 9 : k + 10] == "_"):
                    return True
    return False


def test_brackets_of_any_depth(spark):
    rng = random.Random(3)
    headers = ["".join(rng.choice(["!", "[", "]", ",", " ", "$HOME_NET", "$HOME_NETS", "10.0.0.0/8", "\t", "$X"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["!" + "[" * 40 + "$HOME_NET", "![" + "[x]" * 20 + "]$HOME_NET"]
    df = spark.createDataFrame([(i, h + '(msg:"!$HOME_NET";)') for i, h in enumerate(headers)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(rules.negates_home_net(F.col("t"))).collect()] == [_negates(h) for h in headers]


def test_replay_error_and_separability(spark):
    c = F.col
    df = spark.createDataFrame([(0, 10_000, 0, 12, 1000.0, False), (0, 10_000, 0, 12, 1000.0, True), (0, 10_000, 5, 5, 7.0, False), (0, 10_000, 0, 10, 0.0, False)], "a long, b long, s long, e long, m double, top boolean")
    got = df.select(replay.scale(c("a"), c("b"), c("s"), c("e"), c("m")), replay.uncertainty(c("a"), c("b"), c("s"), c("e"), c("m"), c("top"))).collect()
    assert [(round(r[0], 6), round(r[1], 6)) for r in got] == [(833.333333, 1666.666667), (833.333333, 10000.0), (7.0, 10000.0), (1000.0, 0.0)]
    rng = random.Random(2)
    flows = [(f"u{i}", rng.choice("ab"), t := rng.randrange(3000), t + rng.choice([0, 5, 400])) for i in range(60)]
    apart = lambda f: all(g[0] == f[0] or g[1] != f[1] or g[2] - f[3] > 7 or f[2] - g[3] > 7 for g in flows)
    out = replay.separable(spark.createDataFrame(flows, "uid string, k string, ts_first_us long, ts_last_us long"), ["k"], F.lit(7)).collect()
    assert {r["uid"]: r["separable"] for r in out} == {f[0]: apart(f) for f in flows}


def test_order_of_first_places(spark):
    rows = [(i, k) for i, k in enumerate("cabbcadd")]
    want = [("c", 0, 2), ("a", 1, 2), ("b", 2, 2), ("d", 6, 2)]
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows, "pos long, k string").repartition(n)
        assert [tuple(r) for r in documents.most_common(df, ["k"], "pos").select("k", "first", "n").collect()] == want
    one = spark.createDataFrame([(["b", "a"], None, ["a", "c", "b"])], "x array<string>, y array<string>, z array<string>")
    assert one.select(documents.failures(F.col("x"), F.col("y"), F.col("z"))).first()[0] == ["b", "a", "c"]
    iso = spark.createDataFrame([("2026-01-01T00:00:02Z", "2026-01-01T00:00:01Z"), ("2026-01-01T00:00:01Z", "2026-01-01T00:00:02Z")], "a string, b string")
    assert [r[0] is None for r in iso.select(documents.duration_warning(F.col("a"), F.col("b"))).collect()] == [False, True]
