"""Folders for files that a job makes on its way, where driver and executors can see them."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """URI of a folder that no other call gets, below ``spark.checkpoint.dir``; a local one only where that is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_.isDefined():
            root = set_.get()
        elif spark.sparkContext.master.startswith("local"):
            root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        else:
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def put(uri: str, name: str, content: bytes) -> None:
    """Writes a file whole or not at all, under a name of its own until it is complete; a task that runs twice leaves one."""
    files, base = pafs.FileSystem.from_uri(uri)
    files.create_dir(base, recursive=True)
    aside = f"{base}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(aside) as out:
        out.write(content)
    files.move(aside, f"{base}/{name}")
