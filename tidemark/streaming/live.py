"""Detections as they arrive, capture by capture. An extension: placement itself is a batch matter.

Whether exactly one flow can be a detection's is known only once all flows of
its capture are there.  So a stream of detections isn't joined to a stream of
flows; each micro-batch is placed against the flows of captures that are
complete, and what arrives late within the watermark is counted by window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import correlate
from ..sources.engines import EVE, epoch

PAD = "120 seconds"


def events(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Event files as they appear in a folder; a malformed line ends the query."""
    raw = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(path)
    return raw.select(F.from_json("value", EVE, {"mode": "FAILFAST"}).alias("j")).select("j.*")


def alerts_per_window(stream: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Alerts by window and direction, complete once the pad has passed."""
    a = stream.where("event_type = 'alert'").withColumn("at", F.timestamp_micros(epoch(F.col("timestamp")))).withWatermark("at", PAD)
    return a.groupBy(F.window("at", window), "direction").agg(F.count("*").alias("alerts"))


def place_batches(stream: DataFrame, flows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Places each micro-batch of detections (unique ``did``) on ``flows`` and hands it to ``sink`` with the batch's number.

    Batches may come again after a failure; a sink that overwrites by number
    keeps one copy.
    """
    return stream.writeStream.foreachBatch(lambda batch, n: sink(correlate.place(batch, flows), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
