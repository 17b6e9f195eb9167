"""Rule feeds (plain, gzip or tar), the source registry, device XML and other small documents."""

from __future__ import annotations

import gzip
import io
import posixpath
import re
import tarfile
import tomllib
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

#: Bytes of a feed, inflated, and of one of its files; what is beyond that is refused.
LARGEST, MEMBER = 512 << 20, 64 << 20
KEYS = {"name", "url", "licence", "source_class", "admission_basis"}
OPTIONAL = {"enabled", "exclude_classtypes", "exclude_msg_markers", "msg_brand_marker"}
CLASSES, BASES = ("signature", "ioc-dest", "ioc-name", "identify"), ("metadata-filter", "wholesale", "device-policy")
#: Fixed value: the sources whose rules carry the metadata that ``metadata-filter`` reads.
PUBLISHERS = frozenset({"et/open"})


class BadFeed(ValueError):
    """A feed or registry that can't be used as it is."""


class _Counted:
    """A stream that refuses to give more than ``most`` bytes."""

    def __init__(self, stream, most: int):
        self.stream, self.left = stream, most

    def read(self, size: int = -1) -> bytes:
        try:
            out = self.stream.read(size if size >= 0 else self.left + 1)
        except (OSError, EOFError, zlib.error) as e:
            raise BadFeed(f"not readable: {e}") from None
        self.left -= len(out)
        if self.left < 0:
            raise BadFeed("too large")
        return out


def members(data: bytes, largest: int = LARGEST, member: int = MEMBER) -> Iterator[tuple[str, bytes]]:
    """The files of a feed as they come, one at a time; a plain feed is one file, ``feed.rules``.

    Only regular files count.  More than ``member`` bytes in one file or
    ``largest`` in all, two companion files of one name, and an archive without
    rules are failures: a feed whose shape has changed must not look like one
    that matches nothing.
    """
    if not data:
        raise BadFeed("empty")
    stream = _Counted(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data), largest)
    head = b""
    while len(head) < 512 and (more := stream.read(512 - len(head))):
        head += more
    if head[257:262] != b"ustar":
        yield "feed.rules", head + stream.read()
        return
    stream.left += len(head)
    names, found = set(), False
    try:
        with tarfile.open(fileobj=_Rejoined(head, stream), mode="r|") as tar:
            for m in tar:
                if not m.isfile():
                    continue
                if m.size > member:
                    raise BadFeed(f"{m.name}: too large")
                base = posixpath.basename(m.name)
                if m.name.endswith(".rules"):
                    found = True
                elif base in names:
                    raise BadFeed(f"two companion files are named {base}")
                else:
                    names.add(base)
                yield m.name, tar.extractfile(m).read()
    except tarfile.TarError as e:
        raise BadFeed(f"not readable: {e}") from None
    if not found:
        raise BadFeed("an archive without rules")


class _Rejoined:
    """A stream whose first bytes were read already."""

    def __init__(self, head: bytes, stream: _Counted):
        self.head, self.stream = head, stream

    def read(self, size: int) -> bytes:
        out, self.head = self.head[:size], self.head[size:]
        return out + self.stream.read(size - len(out)) if len(out) < size else out


@udtf(returnType="name string, kind string, bytes long, content binary")
class FeedMembers:
    """A row per file of a feed: ``rules`` with their path in the archive, companion ``data`` files with their bare name."""

    def eval(self, content: bytes):
        for name, data in members(bytes(content or b"")):
            rules = name.endswith(".rules")
            if rules:
                data.decode("utf-8")  # a rule that isn't UTF-8 would be altered silently
            yield (name if rules else posixpath.basename(name), "rules" if rules else "data", len(data), data)


def contents(feeds: DataFrame) -> DataFrame:
    """``feeds(source, content)`` -> ``source, name, kind, bytes, content``: the files of every feed, companions included."""
    spark = feeds.sparkSession
    spark.udtf.register("feed_members", FeedMembers)
    return spark.sql("SELECT f.source, m.* FROM {feeds} f, LATERAL feed_members(f.content) m", feeds=feeds)


def rule_lines(feeds: DataFrame) -> DataFrame:
    """``feeds(source, content)`` -> ``source, line_no, text``: lines of all ``.rules`` files in the order of their names, as UTF-8.

    Files are cut into lines one by one, so no rule runs on from one into the next.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, name, content in zip(*(c.to_pylist() for c in batch.columns)):
                lines = content.decode("utf-8").splitlines()
                yield pa.RecordBatch.from_pydict({"source": [source] * len(lines), "name": [name] * len(lines), "i": list(range(1, len(lines) + 1)), "text": lines}, schema=schema)

    schema = pa.schema([("source", pa.string()), ("name", pa.string()), ("i", pa.int64()), ("text", pa.string())])
    lines = contents(feeds).where("kind = 'rules'").select("source", "name", "content").mapInArrow(cut, "source string, name string, i long, text string")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = lines.groupBy("source", "name").agg(F.max("i").alias("n")).select("source", "name", before.alias("before"))  # a row per file
    return lines.join(starts, ["source", "name"]).select("source", (F.col("before") + F.col("i")).alias("line_no"), "text")


def enabled(sources: DataFrame) -> DataFrame:
    """The sources that contribute rules; those switched off stay in the registry, to be reported."""
    return sources.where("enabled")


def _policy(owner: str, policy: dict) -> None:
    """Fails on a classtype or marker that no rule could have."""
    for value in policy.get("exclude_classtypes", []):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", value):
            raise BadFeed(f"{owner}: no classtype: {value!r}")
    for value in policy.get("exclude_msg_markers", []):
        if not value or unicodedata.category(value[0]) != "So" and value[0] != "\u2139" or any(unicodedata.category(c) not in ("Mn", "Cf") for c in value[1:]):
            raise BadFeed(f"{owner}: no single pictograph: {value!r}")


def registry(spark: SparkSession, text: str, publishers: frozenset = PUBLISHERS) -> tuple[DataFrame, dict]:
    """The sources of a TOML registry and its global policy; unknown and missing keys are errors.

    So are policies that could match nothing: ``metadata-filter`` for a source
    that isn't one of ``publishers``, and impossible classtypes and markers.
    """
    doc = tomllib.loads(text.removeprefix("﻿"))
    if extra := set(doc) - {"source", "admission"}:
        raise BadFeed(f"unknown tables: {sorted(extra)}")
    policy = doc.get("admission", {})
    if extra := set(policy) - {"exclude_classtypes"}:
        raise BadFeed(f"unknown keys in admission: {sorted(extra)}")
    _policy("admission", policy)
    rows, seen = [], set()
    for s in doc.get("source", []):
        if missing := KEYS - set(s):
            raise BadFeed(f"{s.get('name')}: missing {sorted(missing)}")
        if extra := set(s) - KEYS - OPTIONAL:
            raise BadFeed(f"{s['name']}: unknown {sorted(extra)}")
        if s["source_class"] not in CLASSES or s["admission_basis"] not in BASES:
            raise BadFeed(f"{s['name']}: unknown class or basis")
        if s["admission_basis"] == "metadata-filter" and s["name"] not in publishers:
            raise BadFeed(f"{s['name']}: publishes no metadata to filter by")
        _policy(s["name"], s)
        if s["name"].casefold() in seen:
            raise BadFeed(f"{s['name']} is there twice")
        seen.add(s["name"].casefold())
        both = sorted(set(policy.get("exclude_classtypes", [])) | set(s.get("exclude_classtypes", [])))
        rows.append((s["name"], s["url"], s["licence"], s["source_class"], s["admission_basis"], s.get("enabled", True), both, s.get("exclude_msg_markers", []), s.get("msg_brand_marker")))
    schema = "name string, url string, licence string, source_class string, admission_basis string, enabled boolean, exclude_classtypes array<string>, exclude_msg_markers array<string>, msg_brand_marker string"
    return spark.createDataFrame(rows, schema), policy


ENTRY = "receive_time string, subtype string, src string, dst string, sport string, dport string, proto string, app string, threatid string, tid string, direction string, contentver string, config_ver string, severity string, thr_category string"


def threat_log(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a device's threat log."""
    return spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", True).schema(ENTRY).load(path)


def system_info(texts: DataFrame) -> DataFrame:
    """``value`` -> the device's identity, and whether it has threat content at all."""
    x = texts.select(F.regexp_extract("value", r"(?s)<system>.*</system>", 0).alias("x"))
    s = x.select(F.from_xml("x", "hostname string, serial string, model string, `sw-version` string, `app-version` string, `threat-version` string").alias("s")).select("s.*")
    version = F.coalesce(F.trim("`threat-version`"), F.lit(""))
    return s.withColumn("has_threat_content", ~version.isin("", "0"))


def workflow_runs(texts: DataFrame) -> DataFrame:
    """Workflow runs from a list, or from an object that holds the list."""
    item = "array<struct<created_at: string, conclusion: string>>"
    one, two = F.from_json("value", item), F.from_json("value", f"struct<workflow_runs: {item}>")
    found = F.when(F.startswith(F.ltrim("value"), F.lit("[")), one).otherwise(two["workflow_runs"])
    return texts.select(F.explode(found).alias("r")).select(F.unix_micros(F.to_timestamp("r.created_at")).alias("created_us"), F.col("r.conclusion").alias("conclusion"))


def snapshots(manifests: DataFrame) -> DataFrame:
    """One row: the newest of the manifests ``(snapshot_id, created_at)``; ties go to the greater id."""
    return manifests.agg(F.max_by("snapshot_id", F.struct("created_at", "snapshot_id")).alias("snapshot_id"))


def sid_index(texts: DataFrame) -> DataFrame:
    """``value`` (an index as JSON) -> ``sid, source, address_indicator``: null where the schema has no classification.

    An index may be one document or one per source; what any of them lists as
    an address indicator counts for all.
    """
    schema = "schema int, sources map<string, array<bigint>>, address_indicator array<bigint>"
    j = texts.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j")).select("j.*")
    known = F.when(F.col("schema").isin(1, 2, 3), F.col("sources")).otherwise(F.raise_error(F.lit("unknown schema")).cast("map<string, array<bigint>>"))
    rows = j.select("schema", F.explode(known).alias("source", "sids")).select("schema", "source", F.explode("sids").alias("sid"))
    listed = j.where("schema = 3").select(F.explode("address_indicator").alias("sid")).distinct().withColumn("__listed", F.lit(True))
    flag = F.when(F.col("schema") == 3, F.coalesce("__listed", F.lit(False)))
    return rows.join(listed, "sid", "left").select("sid", "source", flag.alias("address_indicator"))
