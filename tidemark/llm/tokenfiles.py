"""Token files: independent zstandard frames, a document index and a seek table.

One file holds documents in ascending order::

    frame 0 .. frame n-1   zstandard frames with content checksums; ids of whole
                           documents as little-endian unsigned 32-bit integers
    index                  skippable frame: a zstandard frame with, per document,
                           doc_id (int64, and a null flag) and number of ids, and
                           per frame its number of documents
    seek table             skippable frame of the public seekable format: sizes
                           and the low half of XXH64 of each frame (and, as the
                           last entry, of the index), then the footer

Any zstandard tool inflates the file; a reader that wants a few documents
fetches the tail and only the frames that hold them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, tokens

SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Bytes of ids after which a frame is closed.
FRAME = 1 << 20
LEVEL = 3
END = 2


class Corrupt(ValueError):
    """A frame that doesn't have the bytes its seek table promises."""


def _low(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Appends documents to ``out`` and ends the file on :meth:`close`."""

    def __init__(self, out, frame: int = FRAME, level: int = LEVEL):
        self.out, self.frame, self.pack = out, frame, zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids: list[bytes] = []
        self.size, self.seeks, self.doc_ids, self.null, self.lengths, self.docs = 0, [], [], [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(ids)
        self.size += len(ids)
        self.doc_ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.lengths.append(len(ids) // 4)
        if self.size >= self.frame:
            self._flush()

    def _flush(self) -> None:
        raw = b"".join(self.ids)
        packed = self.pack.compress(raw)
        self.out.write(packed)
        self.seeks.append((len(packed), len(raw), _low(raw)))
        self.docs.append(len(self.ids))
        self.ids, self.size = [], 0

    def close(self) -> None:
        if self.ids:
            self._flush()
        body = self.pack.compress(struct.pack("<QQ", len(self.lengths), len(self.docs)) + np.array(self.doc_ids, "<i8").tobytes() + np.array(self.null, "u1").tobytes() + np.array(self.lengths, "<u8").tobytes() + np.array(self.docs, "<u8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.seeks.append((8 + len(body), 0, _low(body)))
        table = b"".join(struct.pack("<III", *s) for s in self.seeks) + struct.pack("<IBI", len(self.seeks), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class Reader:
    """Random access to a file's documents; ``source`` has ``size()``, ``seek()`` and ``read()``."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise Corrupt("no seek table")
        seeks = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.raw, self.sums = seeks[:-1].T
        starts = np.concatenate(([0], np.cumsum(seeks[:, 0])))
        self.starts = starts[:-2]
        body = self._at(starts[-2] + 8, seeks[-1, 0] - 8)
        if _low(body) != seeks[-1, 2]:
            raise Corrupt("index")
        body = zstandard.ZstdDecompressor().decompress(body)
        n, f = struct.unpack_from("<QQ", body)
        self.doc_ids = np.frombuffer(body, "<i8", n, 16)
        self.null = np.frombuffer(body, "u1", n, 16 + 8 * n).astype(bool)
        self.lengths = np.frombuffer(body, "<u8", n, 16 + 9 * n).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.frombuffer(body, "<u8", f, 16 + 17 * n)))).astype(np.int64)

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(n))

    def frame(self, k: int) -> list[bytes]:
        """The ids of each document of frame ``k``, checked."""
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.starts[k], self.packed[k]), max_output_size=int(self.raw[k]) or 1)
        if len(raw) != self.raw[k] or _low(raw) != self.sums[k]:
            raise Corrupt(f"frame {k}")
        ends = 4 * np.cumsum(self.lengths[self.first[k] : self.first[k + 1]])
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for k in range(len(self.packed)):
            for i, ids in enumerate(self.frame(k), self.first[k]):
                yield None if self.null[i] else int(self.doc_ids[i]), ids

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents of that id; only their frames are inflated."""
        at = np.nonzero((self.doc_ids == doc_id) & ~self.null)[0]
        frames = np.searchsorted(self.first, at, "right") - 1
        return [np.frombuffer(self.frame(k)[i - self.first[k]], "<u4") for i, k in zip(at, frames)]


def write(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end: int = END, frame: int = FRAME) -> tuple[str, DataFrame]:
    """Encodes ``docs(doc_id, text)`` into token files in ascending doc_id order.

    Returns the folder and its manifest ``(part, file, documents, ids)``; the
    parts' order is the documents' order.  Null texts are empty and only get
    the end id; null doc_ids come first; rows that share a doc_id stay in one
    file, ordered by text.  A text of any length is one document, whole, in a
    frame of its own if it is longer than ``frame``; no rows give an empty
    manifest and no file; other columns are ignored, whatever their names.
    """
    uri = store.scratch(docs.sparkSession, "tokens")
    spaced = vocabulary.startswith("byte")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, encoder, count, total, last = TaskContext.get().partitionId(), None, 0, 0, struct.pack("<I", end)
        frames = (f for f in frames if len(f))
        head = next(frames, None)
        if head is None:
            return
        encoder, name = tokens.encoder(tokens.vocabulary(vocabulary), spaced), f"part-{part:06d}.tok.zst"
        with store.Files(uri).write(name) as out:
            writer = Writer(out, frame)
            while head is not None:
                for doc_id, null, ids in zip(head["doc_id"], head["null"], encoder.encode(list(head["text"]))):
                    writer.add(None if null else int(doc_id), ids + last)
                    count, total = count + 1, total + len(ids) // 4 + 1
                head = next(frames, None)
            writer.close()
        yield pd.DataFrame({"part": [part], "file": [name], "documents": [count], "ids": [total]})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    whole = slim.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("null"), "text")
    return uri, store.table(whole.mapInPandas(pack, "part int, file string, documents long, ids long"), "manifest")


def read(uri: str, manifest: DataFrame) -> DataFrame:
    """Reads token files back: ``doc_id, start, n_tokens, ids_crc32`` per document."""
    start, rows = 0, []
    for r in manifest.orderBy("part").collect():  # a row a file
        rows.append((r["file"], start))
        start += r["ids"]
    spark = manifest.sparkSession
    files = spark.createDataFrame(rows, "file string, start long").repartition(max(1, len(rows)), "file")

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, at in zip(f["file"], f["start"]):
                out: list[tuple] = []
                with store.Files(uri).read(name) as source:
                    for doc_id, ids in Reader(source):
                        out.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    return files.mapInPandas(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
