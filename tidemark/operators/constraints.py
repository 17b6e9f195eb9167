"""Invariants of tables, as queries for the rows that break them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The enumerations of the data model.
ENUMS = {
    "source_class": ("signature", "ioc-dest", "ioc-name", "identify"), "admission_basis": ("metadata-filter", "wholesale", "device-policy"), "mode": ("replay", "offline", "both"),
    "label_basis": ("direct", "indicator-reference"), "direction": ("to_server", "to_client", "unknown"), "capture_format": ("pcap", "pcapng", "pcap.gz", "pcapng.gz"), "input_status": ("complete", "partial"),
    "reason": ("no_flow_match", "ambiguous_flow_match", "unsupported_transport"), "ja4_status": ("present", "not-installed", "probe-failed"), "uri_status": ("gs", "local", "not-recorded"),
}


class Violated(ValueError):
    """Rows that break an invariant."""


def violations(df: DataFrame, rules: dict[str, Column], *key: str) -> DataFrame:
    """``key, rule`` for each rule whose condition (true: broken) holds."""
    return df.select(*key, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).alias("rule"))


def enumerations(df: DataFrame, *key: str) -> DataFrame:
    """Values outside the enumeration of their column; null is allowed."""
    return violations(df, {f"{n} is unknown": ~F.col(n).isin(*values) for n, values in ENUMS.items() if n in df.columns}, *key)


def demand(found: DataFrame) -> None:
    """Raises with the first few violations, before anything is written."""
    if rows := found.limit(5).collect():
        raise Violated("; ".join(str(r.asDict()) for r in rows))


STAMP, ID = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$", r"^[0-9a-f]{16}$"


def source_entries(df: DataFrame) -> DataFrame:
    """Entries of labels ``(did, tier, source, threat)`` beside the terms they were given: what makes one untraceable.

    The terms are those of ``admitted_source`` in ``snapshot_id``; where a table
    doesn't have these columns they aren't looked at.
    """
    blank = lambda n: F.coalesce(F.col(n), F.lit("")) == ""
    rules = {"tier is unknown": ~F.coalesce(F.col("tier").isin(1, 2), F.lit(False)), "no threat": blank("threat"), "no licence": blank("licence"), "source may not label": F.col("source_class") == "identify"}
    if "admitted_source" in df.columns:
        rules["terms of another source"] = ~F.col("admitted_source").eqNullSafe(F.col("source"))
    if "snapshot_id" in df.columns:
        rules["no snapshot id"] = ~F.coalesce(F.col("snapshot_id").rlike(ID), F.lit(False))
    return violations(df, rules, "did")


def stamps(df: DataFrame, *names: str) -> DataFrame:
    """``name, value``: stamps that aren't written in the one format; null is allowed."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]))
    return df.select(each.alias("s")).select("s.*").where(~F.col("value").rlike(STAMP))


def identifiers(df: DataFrame, name: str) -> DataFrame:
    """Values of a content address that aren't 16 hexadecimal digits."""
    return df.select(name).where(~F.coalesce(F.col(name).rlike(ID), F.lit(False)))


def placement(df: DataFrame) -> DataFrame:
    """Placed detections with both or neither of a flow and a reason."""
    return violations(df, {"both a flow and a reason": F.col("uid").isNotNull() & F.col("reason").isNotNull(), "neither a flow nor a reason": F.col("uid").isNull() & F.col("reason").isNull()}, "did")


def skew(device_us: Column, here_us: Column, seconds: int = 30) -> Column:
    """Whether two clocks are too far apart to place one's events by the other."""
    return F.abs(device_us - here_us) > seconds * 1_000_000


def counts(df: DataFrame) -> DataFrame:
    """Counts of a correlation that can't be: more unmatched than detections, or than correlatable ones and unsupported together."""
    broken = {"more unmatched than detections": F.col("unmatched") > F.col("detections_total"), "unsupported exceed the unmatched": F.col("unsupported_transport") > F.col("unmatched"), "negative": F.least("detections_total", "unmatched", "unsupported_transport") < 0}
    return violations(df, broken, "detections_total", "unmatched")


def same_snapshot(engine: str | None, correlator: str | None) -> None:
    """Raises unless detections are correlated with the snapshot whose rules made them."""
    if engine != correlator:
        raise Violated(f"the engine ran snapshot {engine}, its detections are correlated with {correlator}")
