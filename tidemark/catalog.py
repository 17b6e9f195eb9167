"""All queries of the engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import detections, reports, ruleset, scans, warehouse

Query = Callable[[SparkSession, str], DataFrame]
_ALL = detections.QUERIES | ruleset.QUERIES | warehouse.QUERIES | reports.QUERIES | scans.QUERIES


def queries() -> dict[str, Query]:
    return {name: q for name, (q, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
