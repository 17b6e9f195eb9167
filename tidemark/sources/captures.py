"""Packet captures: one row per packet from pcap and pcapng files, and facts about each file.

A capture is read in byte ranges, so that a large file is many tasks, each in
constant memory.  Neither format marks where a record begins, so:

1.  The data source ``capture_ranges`` deals out files and ranges.  The task of a
    range guesses the first record in it (headers that chain) and hops from
    header to header to the first record of the next range.
2.  A file's ranges are put in order, one small row each.  A guess counts only
    if the range before ended there; a wrong one, or one made under wrong
    interfaces, is walked again from where that range really ends.  So a guess
    may cost time, but never changes a row.
3.  The ranges, now with their true starts, are dealt out again and read.

A gzip file has one range, and is inflated as a stream.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the two formats.
PCAP = {b"\xa1\xb2\xc3\xd4": (">", 1_000_000), b"\xd4\xc3\xb2\xa1": ("<", 1_000_000), b"\xa1\xb2\x3c\x4d": (">", 1_000_000_000), b"\x4d\x3c\xb2\xa1": ("<", 1_000_000_000)}
SECTION, INTERFACE, PACKET, SIMPLE, OLD_PACKET, ORDER = 0x0A0D0D0A, 1, 6, 3, 2, 0x1A2B3C4D
LEAST_BODY = {SECTION: 16, INTERFACE: 8, PACKET: 20, OLD_PACKET: 20, SIMPLE: 4}
LARGEST = 16 << 20
LINK_TYPES = {0: "NULL", 1: "ETHERNET", 101: "RAW", 105: "IEEE802_11", 108: "LOOP", 113: "LINUX_SLL", 127: "IEEE802_11_RADIOTAP", 228: "IPV4", 229: "IPV6", 276: "LINUX_SLL2"}
ROW = "path string, pos long, link_type int, snaplen long, ts_us long, caplen long, truncated_at long, fault string, interfaces array<struct<link_type: int, snaplen: long>>, container string"
#: Bytes of a range, and of what is read at once.
SPLIT, CHUNK = 64 << 20, 1 << 18
#: Tasks that read captures, at most.
MOST = 20_000
#: Headers that must follow each other before a guess is tried; bytes of an interface's options that are looked at.
CHAIN, OPTIONS = 24, 4096


def sniff(content: Column) -> Column:
    """``gzip``, ``pcap`` or ``pcapng`` by the first bytes, never by the name; null if none."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(F.startswith(head, F.lit("1F8B")), "gzip").when(head.isin(*[m.hex().upper() for m in PCAP]), "pcap").when(head == "0A0D0D0A", "pcapng")


class Broken(ValueError):
    """Bytes that no capture has."""


class Cut(EOFError):
    """A record that the file ends within; its offset."""


class _Plain:
    """A file that can be read anywhere; a chunk of it is held."""

    def __init__(self, file):
        self.file, self.base, self.held = file, 0, b""

    def at(self, offset: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``offset``."""
        if not self.base <= offset or offset + size > self.base + len(self.held):
            self.file.seek(offset)
            self.base, self.held = offset, self.file.read(max(size, CHUNK))
        return self.held[offset - self.base : offset - self.base + size]


class _Inflated:
    """A gzip file (of any number of members) as a stream: offsets must not go back beyond the chunk that is held."""

    def __init__(self, file):
        self.file, self.base, self.held, self.rest, self.z = file, 0, b"", b"", zlib.decompressobj(31)

    def _more(self) -> bytes:
        while True:
            if self.z.eof:
                tail = (self.z.unused_data + self.rest) or self.file.read(CHUNK)
                if not tail.strip(b"\0"):
                    return b""
                self.z, self.rest = zlib.decompressobj(31), tail
            data = self.rest or self.file.read(CHUNK)
            if not data:
                raise Broken("gzip")
            try:
                out = self.z.decompress(data, CHUNK)
            except zlib.error:
                raise Broken("gzip") from None
            self.rest = self.z.unconsumed_tail
            if out:
                return out

    def at(self, offset: int, size: int) -> bytes:
        while offset + size > self.base + len(self.held):
            drop = min(max(offset - self.base, 0), len(self.held))
            more = self._more()
            self.base, self.held = self.base + drop, self.held[drop:] + more
            if not more:
                break
        return self.held[offset - self.base : offset - self.base + size]


class Walk:
    """Hops over the records of a file that begin in a range, and knows where it ended.

    ``interfaces`` are those of the section at hand (link type, snaplen, ticks a
    second).  With ``unsure``, more may be defined before the range: ``need`` is
    how many at least.
    """

    def __init__(self, kind: str, order: str, interfaces: list, unsure: bool = False):
        self.kind, self.order, self.interfaces, self.unsure = kind, order, [tuple(i) for i in interfaces], unsure
        self.packets, self.need, self.section, self.declared = 0, 0, False, []
        self.next, self.cut, self.fault = 0, None, None

    def records(self, source, at: int, stop: int) -> Iterator[tuple[int, int, int, int]]:
        """(link type, snaplen, microseconds, bytes) of each packet; ``next``, ``cut`` and ``fault`` say how it ended."""
        self.next = at
        try:
            while self.next < stop and (head := source.at(self.next, 8)):
                step = self._pcap if self.kind == "pcap" else self._block
                size, row = step(source, self.next, head)
                if row:
                    self.packets += 1
                    yield row
                self.next += size
        except Cut:
            self.cut = self.next
        except Broken as e:
            self.fault = str(e)

    def _pcap(self, source, at: int, _head: bytes):
        head = source.at(at, 16)
        if len(head) < 16:
            raise Cut
        seconds, part, caplen, _ = struct.unpack(self.order + "IIII", head)
        if caplen > LARGEST:
            raise Broken(f"record of {caplen} bytes")
        if caplen and not source.at(at + 15 + caplen, 1):
            raise Cut
        link, snaplen, unit = self.interfaces[0]
        return 16 + caplen, (link, snaplen, seconds * 1_000_000 + part * 1_000_000 // unit, caplen)

    def _block(self, source, at: int, head: bytes):
        if len(head) < 8:
            raise Cut
        if head[:4] == b"\n\r\r\n":
            self.order = _order(source.at(at + 8, 4))
            self.interfaces, self.section, self.unsure = [], True, False
        kind, size = struct.unpack(self.order + "II", head)
        packet = kind in (PACKET, OLD_PACKET, SIMPLE)
        if size < 12 or size % 4 or packet and size > LARGEST:
            raise Broken(f"block of {size} bytes")
        body = source.at(at + 8, min(size - 12, OPTIONS if kind == INTERFACE else 20))
        trailer = source.at(at + size - 4, 4)
        if len(trailer) < 4:
            raise Cut
        if size - 12 < LEAST_BODY.get(kind, 0):
            raise Broken("interface block" if kind == INTERFACE else "packet block" if packet else "section block")
        if struct.unpack(self.order + "I", trailer)[0] != size:
            raise Broken("block trailer")
        if kind == INTERFACE:
            link, _, snaplen = struct.unpack_from(self.order + "HHI", body)
            self.interfaces.append((link, snaplen, _resolution(self.order, body[8:])))
            self.declared.append((link, snaplen))
        if not packet:
            return size, None
        number = 0 if kind == SIMPLE else struct.unpack_from(self.order + ("I" if kind == PACKET else "H"), body)[0]
        if self.unsure:
            self.need = max(self.need, number - len(self.interfaces) + 1)
            return size, (0, 0, 0, 0)
        if number >= len(self.interfaces):
            raise Broken(f"interface {number} is not defined")
        link, snaplen, unit = self.interfaces[number]
        if kind == SIMPLE:
            original = struct.unpack_from(self.order + "I", body)[0]
            return size, (link, snaplen, 0, min(original, snaplen or original))
        high, low, caplen = struct.unpack_from(self.order + "III", body, 4)
        return size, (link, snaplen, ((high << 32) | low) * 1_000_000 // unit, caplen)


def _order(magic: bytes) -> str:
    for order in "<>":
        if magic == struct.pack(order + "I", ORDER):
            return order
    raise Broken("byte order")


def _resolution(order: str, options: bytes) -> int:
    at = 0
    while at + 4 < len(options):
        code, size = struct.unpack_from(order + "HH", options, at)
        if code == 9 and size:
            return 2 ** (options[at + 4] & 0x7F) if options[at + 4] & 0x80 else 10 ** options[at + 4]
        if code == 0:
            break
        at += 4 + size + (-size) % 4
    return 1_000_000


def begin(source) -> tuple[Walk, int]:
    """A walk at the file's first record, and where that is."""
    head = source.at(0, 24)
    if head[:4] in PCAP:
        order, unit = PCAP[head[:4]]
        if len(head) < 24:
            raise Broken("file header")
        major, _, _, _, snaplen, link = struct.unpack_from(order + "HHiIII", head, 4)
        if major != 2:
            raise Broken(f"version {major}")
        walk = Walk("pcap", order, [(link & 0xFFFF, snaplen, unit)])
        walk.declared = [(link & 0xFFFF, snaplen)]
        return walk, 24
    if head[:4] == b"\n\r\r\n":
        return Walk("pcapng", _order(head[8:12]), []), 0
    raise Broken("not a capture")


def _chained(kind: str, order: str, unit: int, around: int, source, at: int) -> bool:
    """Whether ``CHAIN`` headers that make sense follow each other from ``at``, or as many as there are."""
    for _ in range(CHAIN):
        head = source.at(at, 16 if kind == "pcap" else 8)
        if not head:
            return True
        if kind == "pcap":
            if len(head) < 16:
                return False
            seconds, part, caplen, length = struct.unpack(order + "IIII", head)
            if part >= unit or caplen > length or caplen > LARGEST or abs(seconds - around) > 400_000_000:
                return False
            at += 16 + caplen
        else:
            if len(head) < 8:
                return False
            _, size = struct.unpack(order + "II", head)
            if head[:4] != b"\n\r\r\n" and (size < 12 or size % 4 or size > LARGEST or source.at(at + size - 4, 4) != head[4:8]):
                return False
            if head[:4] == b"\n\r\r\n":
                return source.at(at + 8, 4) in (struct.pack("<I", ORDER), struct.pack(">I", ORDER))
            at += size
    return True


def guess(walk: Walk, source, start: int, stop: int) -> int | None:
    """Where a record of the file may begin first in a range; None if nothing looks like one."""
    whole, step = walk.order + "u4", 1 if walk.kind == "pcap" else 4
    around = struct.unpack(walk.order + "I", source.at(24, 4))[0] if walk.kind == "pcap" else 0
    unit = walk.interfaces[0][2] if walk.interfaces else 0
    start += -start % step
    for base in range(start, stop, CHUNK // 2):
        data = source.at(base, CHUNK // 2 + 16)
        n = min(len(data) - 15, CHUNK // 2, stop - base)
        if n <= 0:
            return None

        def word(shift: int) -> np.ndarray:
            """The number that begins at each of ``n`` places."""
            out = np.empty(-(-(n + 3) // 4) * 4, np.int64)
            for k in range(4):
                own = np.frombuffer(data, whole, (len(data) - shift - k) // 4, shift + k)[: len(out) // 4]
                out[k::4][: len(own)] = own
            return out[:n]

        if walk.kind == "pcap":
            ok = (word(4) < unit) & (word(8) <= word(12)) & (word(8) <= LARGEST) & (abs(word(0) - around) <= 400_000_000)
        else:
            size = word(4)
            ok = ((size >= 12) & (size % 4 == 0) & (size <= LARGEST)) | (word(0) == SECTION)
            ok[np.arange(n) % 4 != 0] = False
        for place in np.flatnonzero(ok).tolist():
            if _chained(walk.kind, walk.order, unit, around, source, base + place):
                return base + place
    return None


def _open(path: str):
    files, own = pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    file = files.open_input_file(own)
    packed = file.read(2) == b"\x1f\x8b"
    file.seek(0)
    return file, _Inflated(file) if packed else _Plain(file), packed


def _files(path: str) -> list[tuple[str, int]]:
    """URIs and sizes of the file at ``path``, or of those in that folder."""
    files, own = pafs.FileSystem.from_uri(path if "://" in path else "file://" + path)
    info = files.get_file_info(own)
    found = [info] if info.type == pafs.FileType.File else [i for i in files.get_file_info(pafs.FileSelector(own)) if i.type == pafs.FileType.File]
    scheme = path.split("://")[0] if "://" in path else "file"
    return sorted((f"file:{i.path}" if scheme == "file" else f"{scheme}://{i.path}", i.size) for i in found)


class _Ranges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        self.ranges = ranges


RANGE = "path string, part int, start long, stop long, guess long, next long, packets long, need long, section boolean, order string, interfaces string, declared string, cut long, fault string"


class CaptureRanges(DataSource):
    """Byte ranges of the captures at ``path``, of ``split`` bytes, each with the records that seem to begin in it."""

    @classmethod
    def name(cls) -> str:
        return "capture_ranges"

    def schema(self) -> str:
        return RANGE

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(self.options["path"], int(self.options.get("split", SPLIT)))


class _RangeReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[InputPartition]:
        out, own, held = [], [], 0
        for path, size in _files(self.path):
            for part, start in enumerate(range(0, max(size, 1), self.split)):
                own.append((path, part, start, min(start + self.split, size)))
                held += own[-1][3] - start
                if held >= self.split:  # small files share a task
                    out.append(_Ranges(own))
                    own, held = [], 0
        return [*out, *([_Ranges(own)] if own else [])] or [_Ranges([])]

    def read(self, partition: _Ranges) -> Iterator[tuple]:
        for path, part, start, stop in partition.ranges:
            file, source, packed = _open(path)
            with file:
                if packed and part:
                    continue  # the file's first range has it all
                yield (path, part, start, 1 << 62 if packed else stop, *_summary(source, part, start, 1 << 62 if packed else stop))


def _summary(source, part: int, start: int, stop: int) -> tuple:
    try:
        walk, at = begin(source)
        if part:
            walk.unsure, walk.declared = walk.kind == "pcapng", []
            at = guess(walk, source, start, stop)
    except Broken as e:
        return (None, None, 0, 0, False, None, None, None, None, str(e))
    if at is None:
        return (None, None, 0, 0, False, None, None, None, None, None)
    order = walk.order
    for _ in walk.records(source, at, stop):
        pass
    return (at, walk.next, walk.packets, walk.need, walk.section, order + walk.order, json.dumps(walk.interfaces), json.dumps(walk.declared), walk.cut, walk.fault)


PLAN = "path string, part int, start long, stop long, pos long, kind string, order string, interfaces string, cut long, fault string, declared string, container string"


def _ordered(path: str, rows: list[dict]) -> Iterator[tuple]:
    """The ranges of a file with their true starts, and last the file's own row (without a part)."""
    rows = sorted(rows, key=lambda r: r["part"])
    pos, declared, cut = 0, [], None
    file, source, packed = _open(path)
    with file:
        try:
            now, at = begin(source)
        except Broken as e:
            yield (path, None, None, None, None, None, None, None, None, str(e), "[]", None)
            return
        fault, kind = None, now.kind
        declared += now.declared
        for r in rows:
            if at >= r["stop"]:
                continue  # a record that fills the range
            yield (path, r["part"], at, r["stop"], pos, kind, now.order, json.dumps(now.interfaces), None, None, None, None)
            if r["guess"] == at and r["order"][0] == now.order and r["need"] <= len(now.interfaces):
                own, fresh = json.loads(r["interfaces"]), kind == "pcap" or r["section"] or not r["part"]
                after = Walk(kind, r["order"][1], own if fresh else now.interfaces + own)
                after.packets, after.next, after.cut, after.fault = r["packets"], r["next"], r["cut"], r["fault"]
                after.declared = [] if kind == "pcap" else json.loads(r["declared"])
            else:
                after = Walk(kind, now.order, now.interfaces)
                for _ in after.records(source, at, r["stop"]):
                    pass
            pos += after.packets
            declared += after.declared
            now, at, cut, fault = after, after.next, after.cut, after.fault
            if cut is not None or fault is not None:
                break
        yield (path, None, None, None, pos, kind, None, None, cut, fault, json.dumps(declared), kind + ".gz" * packed)


_INTERFACES = pa.list_(pa.struct([("link_type", pa.int32()), ("snaplen", pa.int64())]))
_ROW = pa.schema([("path", pa.string()), ("pos", pa.int64()), ("link_type", pa.int32()), ("snaplen", pa.int64()), ("ts_us", pa.int64()), ("caplen", pa.int64()), ("truncated_at", pa.int64()), ("fault", pa.string()), ("interfaces", _INTERFACES), ("container", pa.string())])
_PLAN = pa.schema([("path", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("pos", pa.int64()), ("kind", pa.string()), ("order", pa.string()), ("interfaces", pa.string()), ("cut", pa.int64()), ("fault", pa.string()), ("declared", pa.string()), ("container", pa.string())])


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _plan(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    return pa.Table.from_batches([_columns(list(_ordered(rows[0]["path"], rows)), _PLAN)])


def _packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] is None:
                known = [{"link_type": i[0], "snaplen": i[1]} for i in json.loads(r["declared"])]
                yield _columns([(r["path"], None, None, None, None, None, r["cut"], r["fault"], known, r["container"])], _ROW)
                continue
            file, source, _ = _open(r["path"])
            walk, out = Walk(r["kind"], r["order"], json.loads(r["interfaces"])), []
            with file:
                for i, (link, snaplen, ts, caplen) in enumerate(walk.records(source, r["start"], r["stop"])):
                    out.append((r["path"], r["pos"] + i, link, snaplen, ts, caplen, None, None, None, None))
                    if len(out) == 8192:
                        yield _columns(out, _ROW)
                        out = []
            yield _columns(out, _ROW)


def ranges(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The byte ranges of the captures at ``path`` with the starts that were guessed for them."""
    spark.dataSource.register(CaptureRanges)
    return spark.read.format("capture_ranges").option("path", path).option("split", split).load()


def read(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """A row per packet of each file, and one without a position for the file itself: its container, interfaces, fault and cut.

    ``path`` is a file or a folder of files.  Packets before a fault are given;
    those of a gzip file too, up to where it is damaged.
    """
    # A range is a small row that stands for much work, which adaptive execution would put into one task.
    sizes = [size for _, size in _files(path)]
    tasks = max(1, min(sum(-(-size // split) for size in sizes), MOST, max(spark.sparkContext.defaultParallelism, 4 * sum(sizes) // split)))
    plan = ranges(spark, path, split).repartition(tasks, "path").groupBy("path").applyInArrow(_plan, PLAN)
    return plan.repartition(tasks, "path", "part").mapInArrow(_packets, ROW)


def link_type_name(n: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in LINK_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, n), F.concat(F.lit("LINKTYPE_"), n.cast("string")))


def facts(rows: DataFrame) -> DataFrame:
    """Per file: packets, the link type that is kept (most packets; ties: the lower), its interfaces' snaplens, first and last time by position, what is lost.

    Snaplens are those that the kept type's interfaces declare, with or without
    packets; of all interfaces if none declares that type.  A file without a
    packet and a pcapng that is cut off are faults: of the latter nothing can be
    left out safely.  A pcap that is cut off, and packets of other link types,
    make it ``partial``, with a warning each.
    """
    # Packets are only counted by numbers, a file's own row has the rest: texts and arrays among their aggregates would have every packet sorted.
    by = rows.where("pos is not null").groupBy("path", "link_type").agg(
        F.count("*").alias("n"), F.min("pos").alias("p0"), F.max("pos").alias("p1"), F.min_by("ts_us", "pos").alias("t0"), F.max_by("ts_us", "pos").alias("t1")
    )
    top = by.groupBy("path").agg(
        F.max_by(F.struct("link_type", "n"), F.struct("n", -F.col("link_type"))).alias("top"), F.sum("n").alias("packets"), F.array_sort(F.collect_set("link_type")).alias("types"),
        F.min_by("t0", "p0").alias("first_us"), F.max_by("t1", "p1").alias("last_us"),
    )
    own = rows.where("pos is null").groupBy("path").agg(F.max("truncated_at").alias("truncated_at"), F.max("fault").alias("fault"), F.max("interfaces").alias("interfaces"), F.max("container").alias("container"))
    out = own.join(top, "path", "left")
    packets, kept = F.coalesce("packets", F.lit(0)), F.col("top.link_type")
    lens = lambda x: F.array_sort(F.array_distinct(F.transform(x, lambda i: i["snaplen"])))
    matching = F.filter("interfaces", lambda i: i["link_type"] == kept)
    snaplens = F.when(kept.isNotNull(), F.when(F.size(matching) > 0, lens(matching)).otherwise(lens(F.col("interfaces"))))
    discarded = packets - F.coalesce("top.n", F.lit(0))
    others = F.transform(F.filter("types", lambda t: t != kept), link_type_name)
    cut_off = F.col("truncated_at").isNotNull()
    fault = F.coalesce("fault", F.when(packets == 0, "no packet"), F.when(cut_off & F.startswith("container", F.lit("pcapng")), F.concat(F.lit("pcapng cut off at "), F.col("truncated_at").cast("string"))))
    warnings = F.array_compact(F.array(
        F.when(cut_off, F.concat(F.lit("cut off at "), F.col("truncated_at").cast("string"), F.lit(": the last record is left out"))),
        F.when(discarded > 0, F.concat(discarded.cast("string"), F.lit(" packets left out, of link types "), F.array_join(others, ", "))),
    ))
    status = F.when(fault.isNotNull(), None).when(cut_off | (discarded > 0), "partial").otherwise("complete")
    return out.select(
        "path", "container", packets.alias("packets"), kept.alias("link_type"), link_type_name(kept).alias("link_type_name"), snaplens.alias("snaplens"), "first_us", "last_us", "truncated_at",
        discarded.alias("discarded_packets"), F.when(discarded > 0, others).alias("discarded_link_types"), fault.alias("fault"), status.alias("input_status"), F.when(fault.isNull(), warnings).alias("warnings"),
    )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of the files as they are, and their container format; read as streams, so of any size."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0).to_pylist():
                digest, size, head = hashlib.sha256(), 0, b""
                file, _, _ = _open(own)
                with file:
                    while chunk := file.read(1 << 20):
                        digest.update(chunk)
                        size, head = size + len(chunk), head or chunk[:4]
                yield pa.RecordBatch.from_pylist([{"path": own, "bytes": size, "sha256": digest.hexdigest(), "head": head}])

    paths = spark.createDataFrame([(own,) for own, _ in _files(path)], "path string").repartition("path")
    return paths.mapInArrow(measure, "path string, bytes long, sha256 string, head binary").select("path", "bytes", "sha256", sniff(F.col("head")).alias("container"))
