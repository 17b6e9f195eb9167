"""Rule snapshots: content-addressed folders that are written aside, verified, and renamed into place.

A snapshot's content is rows of ``path, at, content``: pieces of files, in the
order of ``at`` within each.  So a file of any size is many rows; nothing here
holds one whole.  Below ``root/<id>`` the pieces are a Parquet table, and
``manifest.json`` is written last.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.feeds import sid_index as read_index
from . import rules

#: Bytes of a piece of a data file.
PIECE = 1 << 14
VERSION = 1
RULES, INDEX, DATA = "rules.rules", "sid_index.json", "data"
SCHEMA = "path string, at struct<source: string, number: bigint, text: string>, content binary"
ID, NAME = r"^[0-9a-f]{16}$", r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
MANIFEST = "manifest_version int, snapshot_id string, created_at string, version string, total_admitted bigint, total_ja4_admitted bigint, sources array<struct<source: string, fetched: bigint, admitted: bigint, ja4_admitted: bigint>>"


class Damaged(ValueError):
    """A snapshot that isn't what its name or its manifest says."""


def _at(source, number, text=None):
    return F.struct(source.cast("string").alias("source"), number.cast("bigint").alias("number"), (F.lit(None) if text is None else text).cast("string").alias("text")).alias("at")


def pieces(path, content, size: int = PIECE):
    """A file's content as an array of ``(number, content)`` pieces; an empty file has one."""
    count = F.greatest(F.ceil(F.length(content) / size), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.cast("bigint").alias("number"), F.substring(content, i * size + 1, F.lit(size)).alias("content")))


def components(judged: DataFrame, data: DataFrame | None = None) -> DataFrame:
    """What a snapshot consists of: admitted rules in order, the index of their sids, and data files ``data(source, name, content)``.

    A data file whose name isn't a plain one, and one of a source without
    rules, are failures: the first would be a path, the second part of no ruleset.
    """
    own = judged.where("state = 'active' AND verdict IS NULL").select("source", F.coalesce(rules.sid(F.col("text")), F.lit(-1)).alias("sid"), "text", rules.address_indicator(F.trim("text")).alias("indicator"))
    lines = own.select(F.lit(RULES).alias("path"), _at(F.col("source"), F.col("sid"), F.col("text")), F.encode(F.concat("text", F.lit("\n")), "utf-8").alias("content"))
    block = F.floor(F.col("sid") / 10_000)
    sids = own.where("sid >= 0").groupBy("source", block.alias("block")).agg(F.array_sort(F.collect_set("sid")).alias("sids"), F.array_sort(F.collect_set(F.when(F.col("indicator"), F.col("sid")))).alias("listed"))
    document = F.to_json(F.struct(F.lit(3).alias("schema"), F.create_map("source", "sids").alias("sources"), F.col("listed").alias("address_indicator")))
    index = sids.select(F.lit(INDEX).alias("path"), _at(F.col("source"), F.col("block")), F.encode(F.concat(document, F.lit("\n")), "utf-8").alias("content"))
    out = lines.unionByName(index)
    if data is None:
        return out
    known = own.select("source").distinct().withColumn("__known", F.lit(True))
    plain = F.when(~F.col("name").rlike(NAME), F.raise_error(F.concat(F.lit("not a plain file name: "), "name")).cast("string")).when(F.col("__known").isNull(), F.raise_error(F.concat(F.lit("data of a source without rules: "), "source")).cast("string")).otherwise(F.concat_ws("/", F.lit(DATA), "source", "name"))
    files = data.join(known, "source", "left").select(plain.alias("path"), F.explode(pieces(F.lit(""), F.col("content"))).alias("p"))
    return out.unionByName(files.select("path", _at(F.lit(None), F.col("p.number")), F.col("p.content").alias("content")))


def address(parts: DataFrame) -> DataFrame:
    """One row: the content address of ``parts(path, at, content)``, 16 hex digits; the order of rows doesn't matter.

    SHA-256 over path, a zero byte, the length (8 bytes) and the content of each
    file, in path order.  The hash is a chain, so it is one task's; the rows
    come to it sorted and stream through, and it holds no more than a batch.
    """
    length = parts.groupBy("path").agg(F.sum(F.length("content").cast("bigint")).alias("size"))
    sized = parts.join(length, "path").select("path", "at", "content", "size").repartition(1).sortWithinPartitions("path", "at").select("path", "content", "size")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, now = hashlib.sha256(), None
        for batch in batches:
            for path, content, size in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if path != now:
                    now = path
                    h.update(path.encode() + b"\0" + size.to_bytes(8, "big"))
                h.update(content.as_buffer() or b"")
        yield pa.RecordBatch.from_pydict({"snapshot_id": [h.hexdigest()[:16]]})

    return sized.mapInArrow(digest, "snapshot_id string")


class _Store:
    """The cluster's file system below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self.path = lambda *p: jvm.org.apache.hadoop.fs.Path("/".join((root.rstrip("/"), *p)))
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def has(self, *p: str) -> bool:
        return self.fs.exists(self.path(*p))

    def write(self, text: str, *p: str) -> None:
        out = self.fs.create(self.path(*p), True)
        out.write(bytearray(text.encode()))
        out.close()


def _id(found: DataFrame) -> str:
    return (found.first() or [hashlib.sha256().hexdigest()[:16]])[0]


def write(spark: SparkSession, root: str, parts: DataFrame, admissions: DataFrame, created_at: str, version: str = "1") -> tuple[str, bool]:
    """Commits a snapshot below ``root``; its id, and whether it is new.

    The content is written beside its place, read back and hashed, and only then
    renamed, manifest and all, so under an id there is the whole snapshot or
    nothing.  Content that is there already is verified and left as it is, with
    the manifest of its first write; a damaged one is refused, not repaired,
    since labels name it.  A snapshot without a rule is refused.
    """
    store, aside = _Store(spark, root), f".staged-{uuid.uuid4().hex}"
    staged = "/".join((root.rstrip("/"), aside))
    try:
        parts.write.parquet(f"{staged}/components")
        held = spark.read.schema(SCHEMA).parquet(f"{staged}/components")
        if not held.where(F.col("path") == RULES).limit(1).count():
            raise Damaged("a snapshot without rules would label nothing")
        name = _id(address(held))
        if store.has(name):
            return _again(spark, root, name)
        counted = rules.balanced(admissions).select("source", "fetched", "admitted", "ja4_admitted").orderBy("source").collect()  # a row per feed
        total = lambda k: sum(r[k] for r in counted)
        document = {"manifest_version": VERSION, "snapshot_id": name, "created_at": created_at, "version": version, "total_admitted": total("admitted"), "total_ja4_admitted": total("ja4_admitted"), "sources": [r.asDict() for r in counted]}
        store.write(json.dumps(document, sort_keys=True) + "\n", aside, "manifest.json")
        if not store.fs.rename(store.path(aside), store.path(name)) or store.has(name, aside):
            if store.has(name, aside):  # some file systems move into a folder that is there
                store.fs.delete(store.path(name, aside), True)
            return _again(spark, root, name)  # another writer was faster
        return name, True
    finally:
        store.fs.delete(store.path(aside), True)


def _again(spark: SparkSession, root: str, name: str) -> tuple[str, bool]:
    load(spark, root, name)
    return name, False


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """``snapshot_id, created_at, fault`` of every folder below ``root`` that may be a snapshot; those with a fault are to be skipped, aloud."""
    lines = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").load(root)
    folder = F.element_at(F.split("path", "/"), -2)
    rows = lines.where(~F.startswith(folder, F.lit("."))).select(folder.alias("folder"), F.from_json(F.decode("content", "utf-8"), f"{MANIFEST}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("m"))
    total = lambda k: F.aggregate("m.sources", F.lit(0).cast("bigint"), lambda a, s: a + s[k])
    fault = (
        F.when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), "not a JSON object").when(~F.col("m.manifest_version").eqNullSafe(F.lit(VERSION)), "another format version")
        .when(~F.col("m.snapshot_id").eqNullSafe(F.col("folder")), "claims to be another snapshot").when(~F.col("folder").rlike(ID), "not an id")
        .when(F.col("m.created_at").isNull() | F.col("m.sources").isNull() | F.col("m.version").isNull(), "a field is missing")
        .when(~F.col("m.total_admitted").eqNullSafe(total("admitted")) | ~F.col("m.total_ja4_admitted").eqNullSafe(total("ja4_admitted")), "totals don't match the sources")
    )
    return rows.select(F.col("folder").alias("snapshot_id"), F.col("m.created_at").alias("created_at"), F.col("m.total_admitted").alias("total_admitted"), fault.alias("fault"))


def load(spark: SparkSession, root: str, name: str | None = None) -> tuple[str, DataFrame, list[str]]:
    """The id, the parts, and warnings of one snapshot; without a name the newest (ties: the greater id), saying which were skipped.

    A snapshot that is asked for is never replaced by another.  Its content is
    hashed again, and its rules are counted against the manifest.
    """
    known, warnings = manifests(spark, root), []
    if name is None:
        best = known.where("fault IS NULL").agg(F.max_by("snapshot_id", F.struct("created_at", "snapshot_id"))).first()[0]
        if best is None:
            raise Damaged("no usable snapshot")
        skipped = known.where("fault IS NOT NULL").orderBy("snapshot_id").limit(20).collect()
        name, warnings = best, [f"snapshot {r['snapshot_id']} was skipped: {r['fault']}" for r in skipped]
    row = known.where(F.col("snapshot_id") == name).first()
    if row is None:
        raise Damaged(f"no snapshot {name}")
    if row["fault"]:
        raise Damaged(f"snapshot {name}: {row['fault']}")
    parts = spark.read.schema(SCHEMA).parquet(f"{root.rstrip('/')}/{name}/components")
    found = _id(address(parts))
    if found != name:
        raise Damaged(f"snapshot {name} has the content of {found}")
    held = parts.where(F.col("path") == RULES).count()
    if held != row["total_admitted"]:
        raise Damaged(f"snapshot {name} has {held} rules, its manifest {row['total_admitted']}")
    return name, parts, warnings


def index(parts: DataFrame) -> DataFrame:
    """``sid, source, address_indicator`` of a snapshot's own index."""
    return read_index(parts.where(F.col("path") == INDEX).select(F.decode("content", "utf-8").alias("value")))
