"""Captures read in byte ranges against a plain reader of whole files."""

import gzip
import io
import random
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.sources import captures


def plain(data):
    """Packets of a whole file (link type, snaplen, microseconds, bytes), the offset at which it is cut off, its fault."""
    out, links = [], []
    try:
        if data[:4] in captures.PCAP:
            end, unit = captures.PCAP[data[:4]]
            version, *_, snap, link = struct.unpack_from(end + "HHiIII", data, 4)
            if version != 2:
                return [], None, f"version {version}"
            at = 24
            while at < len(data):
                if at + 16 > len(data):
                    return out, at, None
                sec, part, size, _ = struct.unpack_from(end + "IIII", data, at)
                if size > captures.LARGEST:
                    return out, None, f"record of {size} bytes"
                if at + 16 + size > len(data):
                    return out, at, None
                out.append((link, snap, sec * 1_000_000 + part * 1_000_000 // unit, size))
                at += 16 + size
            return out, None, None
        at = 0
        while at < len(data):
            if data[at : at + 4] == b"\n\r\r\n":
                end, links = "<" if data[at + 8 : at + 12] == b"\x4d\x3c\x2b\x1a" else ">", []
            kind, size = struct.unpack_from(end + "II", data, at)
            if at + size > len(data):
                return out, at, None
            body = data[at + 8 : at + size - 4]
            if kind == 1:
                unit = 10**9 if body[8:10] in (b"\x09\0", b"\0\x09") else 10**6
                links.append((*struct.unpack_from(end + "HHI", body)[::2], unit))
            elif kind == 6:
                number, high, low, caplen = struct.unpack_from(end + "IIII", body)
                if number >= len(links):
                    return out, None, f"interface {number} is not defined"
                link, snap, unit = links[number]
                out.append((link, snap, (high << 32 | low) * 1_000_000 // unit, caplen))
            at += size
        return out, None, None
    except struct.error:
        return out, at, None


def pcap(rng, end, nano, payload):
    out = struct.pack(end + "IHHiIII", 0xA1B23C4D if nano else 0xA1B2C3D4, 2, 4, 0, 0, 65535, rng.choice([1, 101]))
    for i in range(rng.randint(0, 120)):
        body = payload(rng)
        out += struct.pack(end + "IIII", 1_700_000_000 + i, rng.randrange(1_000_000), len(body), len(body)) + body
    return out


def block(end, kind, body):
    body += b"\0" * (-len(body) % 4)
    return struct.pack(end + "II", kind, len(body) + 12) + body + struct.pack(end + "I", len(body) + 12)


def pcapng(rng, end, payload):
    out = b""
    for _ in range(rng.randint(1, 3)):
        out += block(end, 0x0A0D0D0A, struct.pack(end + "IHHq", 0x1A2B3C4D, 1, 0, -1))
        known = 0
        for _ in range(rng.randint(1, 80)):
            kind = rng.random()
            if kind < 0.1 or not known:
                options = struct.pack(end + "HHBxxxHH", 9, 1, 9, 0, 0) if rng.random() < 0.5 else b""
                out += block(end, 1, struct.pack(end + "HHI", rng.choice([1, 101]), 0, rng.choice([96, 65535])) + options)
                known += 1
            elif kind < 0.2:
                out += block(end, 4, rng.randbytes(rng.randint(0, 900)))
            else:
                body, number = payload(rng), known if rng.random() < 0.002 else rng.randrange(known)
                out += block(end, 6, struct.pack(end + "IIIII", number, 0, rng.randrange(1 << 30), len(body), len(body)) + body)
        end = rng.choice("<>")
    return out


def noise(rng):
    return rng.randbytes(rng.choice([0, 4, 60, 300, 1500]))


def nested(rng):
    """Packets that carry captures: what looks like records lies within records."""
    inner = random.Random(rng.random())
    return pcap(inner, "<", False, noise)[: inner.randint(0, 3000)] if inner.random() < 0.5 else pcapng(inner, "<", noise)[: 4 * inner.randint(0, 900)]


def ranged(path, data, split):
    """The same from ranges of ``split`` bytes, as the tasks would."""
    name = f"file:{path}"
    rows = [dict(zip([c.split()[0] for c in captures.RANGE.split(", ")], (name, part, start, min(start + split, len(data)), *captures._summary(captures._Plain(io.BytesIO(data)), part, start, min(start + split, len(data)))))) for part, start in enumerate(range(0, len(data), split))]
    plan = list(captures._ordered(name, rows))
    out = []
    for _, part, start, stop, pos, kind, order, known, *_ in plan[:-1]:
        assert pos == len(out)
        out += captures.Walk(kind, order, captures.json.loads(known)).records(captures._Plain(io.BytesIO(data)), start, stop)
    return out, plan[-1][8], plan[-1][9]


@pytest.mark.parametrize("seed", range(40))
def test_ranges_equal_the_whole(tmp_path, seed):
    rng = random.Random(seed)
    payload = rng.choice([noise, nested])
    data = pcap(rng, rng.choice("<>"), rng.random() < 0.5, payload) if rng.random() < 0.5 else pcapng(rng, rng.choice("<>"), payload)
    if rng.random() < 0.3:
        data = data[: rng.randint(24, len(data))]
    (tmp_path / "x").write_bytes(data)
    want = plain(data)
    for split in (64, 1000, 5000, 1 << 20):
        assert ranged(tmp_path / "x", data, split) == want


def test_many_tasks_read_one_file(spark, tmp_path):
    rng = random.Random(7)
    whole = {"a": pcap(rng, "<", False, noise) * 1, "b": pcapng(rng, "<", noise), "c": pcap(rng, ">", True, nested)}
    for name, data in whole.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "d").write_bytes(gzip.compress(whole["a"][:500]) + gzip.compress(whole["a"][500:]))
    rows = captures.read(spark, str(tmp_path), split=2000)
    assert captures.ranges(spark, str(tmp_path), split=2000).rdd.getNumPartitions() > 8
    got = {}
    for r in rows.where("pos is not null").orderBy("path", "pos").collect():
        got.setdefault(r["path"][-1], []).append((r["link_type"], r["snaplen"], r["ts_us"], r["caplen"]))
    want = {name: plain(data)[0] for name, data in whole.items()}
    assert got == want | {"d": want["a"]}
    facts = {r["path"][-1]: r for r in captures.facts(rows).collect()}
    assert (facts["d"]["container"], facts["d"]["packets"], facts["d"]["fault"]) == ("pcap.gz", len(want["a"]), None)


def test_memory_of_a_large_stream(tmp_path):
    """A large gzip file and a large record are never held whole."""
    import tracemalloc

    zeros = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1) + b"".join(struct.pack("<IIII", 1, 0, 1 << 20, 1 << 20) + bytes(1 << 20) for _ in range(100))
    (tmp_path / "z.gz").write_bytes(gzip.compress(zeros))
    del zeros
    file, source, _ = captures._open(f"file:{tmp_path}/z.gz")
    tracemalloc.start()
    with file:
        walk, at = captures.begin(source)
        assert sum(1 for _ in walk.records(source, at, 1 << 62)) == 100 and (walk.cut, walk.fault) == (None, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20


def test_kept_interfaces_and_refusals(spark, tmp_path):
    head = block("<", 0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    idb = lambda link, snap: block("<", 1, struct.pack("<HHI", link, 0, snap))
    epb = lambda i: block("<", 6, struct.pack("<IIIII", i, 0, 5, 4, 4) + b"abcd")
    mixed = head + idb(1, 65535) + idb(1, 96) + idb(101, 200) + epb(0) * 2 + epb(2)
    (tmp_path / "m").write_bytes(mixed)
    (tmp_path / "n").write_bytes(mixed[:-2])
    got = {r["path"][-1]: r for r in captures.facts(captures.read(spark, str(tmp_path))).collect()}
    assert (got["m"]["snaplens"], got["m"]["discarded_packets"], got["m"]["discarded_link_types"], got["m"]["input_status"]) == ([96, 65535], 1, ["RAW"], "partial")
    assert got["m"]["warnings"] == ["1 packets left out, of link types RAW"]
    assert got["n"]["fault"].startswith("pcapng cut off at") and got["n"]["input_status"] is None and got["n"]["warnings"] is None


def test_files_are_read_by_many_tasks_and_packets_are_not_sorted(spark, tmp_path):
    header = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for k in range(24):
        (tmp_path / f"f{k}").write_bytes(header + b"".join(struct.pack("<IIII", 1_700_000_000 + i, k, 40, 40) + bytes(40) for i in range(50)))
    rows = captures.read(spark, str(tmp_path))
    assert rows.where("pos is not null").select(F.spark_partition_id()).distinct().count() > 1
    facts = captures.facts(rows)
    assert {(r["packets"], r["last_us"] - r["first_us"]) for r in facts.collect()} == {(50, 49_000_000)} and facts.count() == 24
    # What sorts has nothing but rows of files, or of link types of files, below it.
    plan = captures.facts(rows.where("pos is not null"))._jdf.queryExecution().sparkPlan().toString()
    per_packet = [line for line in plan.splitlines() if "Aggregate(" in line and "partial_" in line and "ts_us" in line]
    assert per_packet and all("HashAggregate(" in line and "ObjectHashAggregate(" not in line for line in per_packet)
