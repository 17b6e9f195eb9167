"""Replays: a device's wall clock as capture time, and whether that tells two flows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scale(first: Column, last: Column, begun: Column, ended: Column, multiplier: Column) -> Column:
    """Capture time per wall time as it was (all in microseconds); the asked multiplier where no wall time passed."""
    wall = ended - begun
    return F.when(wall <= 0, multiplier.cast("double")).otherwise((last - first).cast("double") / F.nullif(wall, F.lit(0)))


def uncertainty(first: Column, last: Column, begun: Column, ended: Column, multiplier: Column, topspeed: Column) -> Column:
    """Microseconds by which a capture time that was read from the wall clock may be wrong.

    What the replay took beyond its plan, in capture time; the whole span where
    relative times were given up or no wall time passed.
    """
    span, wall = (last - first).cast("double"), (ended - begun).cast("double")
    planned = F.when(multiplier == 0, wall).otherwise(span / F.nullif(multiplier.cast("double"), F.lit(0.0)))
    return F.when(F.coalesce(topspeed, F.lit(False)) | (wall <= 0), F.abs(span)).otherwise(F.abs(wall - planned) * scale(first, last, begun, ended, multiplier))


def capture_time(wall: Column, first: Column, begun: Column, by: Column) -> Column:
    """A wall-clock time as capture time, microseconds."""
    return F.rint(first + (wall - begun) * by).cast("bigint")


def separable(flows: DataFrame, key: list[str], error: Column) -> DataFrame:
    """``flows`` with ``separable``: whether a time that may be wrong by ``error`` could belong to no other flow of the same ``key``.

    Flows of a key in order of their begin: a flow stands apart if it begins more
    than the error after every earlier one has ended (the running maximum of
    their ends), and the next begins that much after its own end.
    """
    order = Window.partitionBy(*key).orderBy("ts_first_us", "ts_last_us", "uid")
    ended = F.max("ts_last_us").over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead("ts_first_us").over(order)
    apart = F.coalesce(F.col("ts_first_us") - ended > error, F.lit(True)) & F.coalesce(following - F.col("ts_last_us") > error, F.lit(True))
    return flows.withColumn("separable", apart)
