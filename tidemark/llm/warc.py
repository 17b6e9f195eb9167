"""WARC archives: writing, normalising and reading back.

A crawler that gzips a whole archive as one stream leaves a file that can only
be read from its start.  The normaliser inflates such a stream once, writes
every record as a gzip member of its own, and beside it an index of offsets,
so single records can be fetched.  Payloads that occur again are ``revisit``
records, which name the response that holds the payload.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

#: Payloads of fewer bytes are never written as revisits.
LEAST = 100
_READ = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Malformed(ValueError):
    """A stream that isn't a sequence of whole WARC records."""


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise Malformed(first[:40])
    fields = {k.strip().lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise Malformed("record end")
    return fields, rest[:n]


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; only one record is held at a time."""
    have = bytearray()
    for chunk in chunks:
        have += chunk
        while True:
            end = have.find(b"\r\n\r\n")
            if end < 0:
                break
            fields = dict(x.split(b":", 1) for x in bytes(have[:end]).lower().split(b"\r\n")[1:])
            size = end + 8 + int(fields[b"content-length"])
            if len(have) < size:
                break
            yield bytes(have[:size])
            del have[:size]
    if have:
        raise Malformed(f"{len(have)} bytes after the last record")


def inflate(source) -> Iterator[bytes]:
    """The content of a gzip stream of one or more members, once from its start."""
    packed = zlib.decompressobj(31)
    while data := source.read(_READ):
        while data:
            yield packed.decompress(data, _READ * 4)
            while packed.unconsumed_tail:
                yield packed.decompress(packed.unconsumed_tail, _READ * 4)
            data = packed.unused_data if packed.eof else b""
            if packed.eof:
                packed = zlib.decompressobj(31)


def member(raw: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _field(text: str) -> str:
    """A header value on one line; characters that would end or trim the line are percent-encoded, all others stay."""
    return re.sub(r"[\x00-\x1f\x7f]|^ | $", lambda m: f"%{ord(m[0]):02X}", text)


def _urn(page_id) -> str:
    return f"<urn:page:{page_id}>"


def _page(value: str | None) -> int | None:
    name = value[len("<urn:page:") : -1] if value else ""
    return int(name) if name not in ("", "None") else None


def digests(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages(page_id, url, html)`` with ``n, digest, of``: size and SHA-256 of the payload and the page that has it first.

    ``of`` is null unless another page with the same payload of ``least`` bytes
    or more has a smaller page_id; rows that share the smallest page_id are all
    responses, and a null page_id is never referred to.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).withColumns({"n": F.length("html").cast("long"), "digest": F.sha2("html", 256)})
    first = own.where(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    revisit = (F.col("n") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return own.join(first, "digest", "left").withColumn("of", F.when(revisit, F.col("first"))).drop("first")


def write(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes whole-file gzip archives; returns their list ``(folder, file, records)``."""
    folder = store.scratch(pages.sparkSession, "warc-whole")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, count, gz = f"part-{TaskContext.get().partitionId():06d}.warc.gz", 0, zlib.compressobj(6, zlib.DEFLATED, 31)
        frames = (f for f in frames if len(f))
        f = next(frames, None)
        if f is None:
            return
        with store.Files(folder).write(name) as out:
            while f is not None:
                for page, url, html, n, digest, of in f[["page_id", "url", "html", "n", "digest", "of"]].itertuples(index=False):
                    fields = {"WARC-Record-ID": _urn(page), "WARC-Date": "1970-01-01T00:00:00Z", **({} if url is None else {"WARC-Target-URI": _field(url)}), "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
                    if of is None:
                        raw = record("response", fields, http + html)
                    else:
                        raw = record("revisit", fields | {"WARC-Profile": PROFILE, "WARC-Refers-To": _urn(of)}, http)
                    out.write(gz.compress(raw))
                    count += 1
                f = next(frames, None)
            out.write(gz.flush())
        yield pd.DataFrame({"folder": [folder], "file": [name], "records": [count]})

    rows = digests(pages, least).withColumns({k: F.col(k).cast("string") for k in ("page_id", "of")})
    return store.table(rows.mapInPandas(pack, "folder string, file string, records long"), "warc-list")


def _dealt(files: DataFrame) -> DataFrame:
    return files.repartition(max(1, files.count()), "file")


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrites each archive of ``(folder, file)`` with a member per record and a sidecar index.

    The index has a JSON line per record: id, type, URI, offset and size of its
    member.  Returns ``(folder, file, records)`` of the new archives.
    """
    to = store.scratch(archives.sparkSession, "warc")

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for folder, name in zip(f["folder"], f["file"]):
                offset = count = 0
                files = store.Files(to)
                with store.Files(folder).read(name) as source, files.write(name) as out, files.write(f"{name}.idx") as index:
                    for raw in records(inflate(source)):
                        fields, _ = parse(raw)
                        own = member(raw)
                        out.write(own)
                        entry = {"id": fields["warc-record-id"], "type": fields["warc-type"], "uri": fields.get("warc-target-uri"), "offset": offset, "size": len(own)}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, count = offset + len(own), count + 1
                yield pd.DataFrame({"folder": [to], "file": [name], "records": [count]})

    return store.table(_dealt(archives).mapInPandas(rewrite, "folder string, file string, records long"), "warc-list")


def fetch(folder: str, name: str, entry: dict) -> tuple[dict[str, str], bytes]:
    """One record of a normalised archive, by its index entry alone."""
    with store.Files(folder).read(name) as source:
        source.seek(entry["offset"])
        return parse(zlib.decompress(source.read(entry["size"]), 31))


def read(archives: DataFrame) -> DataFrame:
    """Reads normalised archives through their indexes, and checks every payload.

    A row per record: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to.  A revisit's size is that of the payload it stands for.
    """

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for folder, name in zip(f["folder"], f["file"]):
                files, out = store.Files(folder), []
                with files.read(name) as source, files.fs.open_input_stream(files.path(f"{name}.idx")) as index:
                    for line in _lines(index):
                        entry = json.loads(line)
                        source.seek(entry["offset"])
                        fields, block = parse(zlib.decompress(source.read(entry["size"]), 31))
                        head, _, payload = block.partition(b"\r\n\r\n")
                        n = int(head.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        if entry["type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                            raise Malformed(f"payload of {entry['id']}")
                        out.append((_page(entry["id"]), entry["uri"], n, digest, entry["type"], _page(fields.get("warc-refers-to"))))
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    return _dealt(archives).mapInPandas(load, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _lines(stream) -> Iterator[bytes]:
    left = b""
    while data := stream.read(_READ):
        *lines, left = (left + data).split(b"\n")
        yield from lines


def _rows(out: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return f.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages written as whole-file archives, normalised, and read back.

    Null html is an empty payload and a null url no URI; a url comes back as it
    was, but for control characters and a space at either end, which are
    percent-encoded.  A payload is held whole by the task that writes or reads
    it.  Null page_ids and repeated rows have records of their own; no rows give no rows; other columns are ignored.
    """
    return read(normalise(write(pages, least)))
