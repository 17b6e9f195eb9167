"""Shared scratch space of a job: tables and files that every executor can see.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only where
that setting is absent (tests, notebooks) is a local one made and set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """URI of the shared folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if named is None:
        now = jsc.getCheckpointDir()
        if now.isDefined():
            return now.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a folder that no other call gets; it isn't made yet."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: the lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.tidemark_path = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes what :func:`table` wrote, once nothing reads it any more."""
    path = getattr(df, "tidemark_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


class Files:
    """Files under one URI, for the tasks that write or read them."""

    def __init__(self, uri: str):
        self.fs, self.base = pafs.FileSystem.from_uri(uri)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, name: str):
        """Context manager: a stream that becomes file ``name`` when it closes well.

        A retried or speculative task writes under a name of its own and renames
        at the end, so a reader never sees half a file.
        """
        return _Pending(self, name)

    def read(self, name: str):
        return self.fs.open_input_file(self.path(name))


class _Pending:
    def __init__(self, files: Files, name: str):
        self.files, self.name, self.tmp = files, files.path(name), files.path(f".{name}.{uuid.uuid4().hex}")

    def __enter__(self):
        self.files.fs.create_dir(self.files.base, recursive=True)
        self.out = self.files.fs.open_output_stream(self.tmp)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.files.fs.move(self.tmp, self.name)
        else:
            self.files.fs.delete_file(self.tmp)
