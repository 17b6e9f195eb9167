"""Documents of a run: the label document, the run document, the notice, and their canonical form."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.net import canonical_json

#: Keys of the run and input blocks that differ between two equal runs.
RUN_KEYS, INPUT_KEYS = ("started_at", "finished_at", "duration_seconds"), ("path", "filename", "uri")


def records(labels: DataFrame, flows: DataFrame) -> DataFrame:
    """Labels with their flow, in document order: by first time, then uid."""
    f = flows.select("uid", F.struct("uid", "proto", "src_ip", "src_port", "dst_ip", "dst_port", "ts_first_us", "ts_last_us").alias("flow"))
    return labels.join(f, "uid").select("flow", "best_tier", "labels", "sources").orderBy("flow.ts_first_us", "flow.uid")


def render(document: dict) -> str:
    """The one text of a document: sorted keys, two spaces, UTF-8, no NaN, a line break at the end."""
    return json.dumps(document, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def label_lines(labels: DataFrame, flows: DataFrame) -> DataFrame:
    """The records as JSON lines: written by all executors, for runs that no driver should gather."""
    return records(labels, flows).select(F.to_json(F.struct("*")).alias("value"))


def notice(sources: DataFrame) -> DataFrame:
    """``source, licence`` -> a line of attribution per source, sorted; two licences of one source are a conflict."""
    one = sources.groupBy("source").agg(F.array_sort(F.collect_set("licence")).alias("l"))
    licence = F.when(F.size("l") > 1, F.raise_error(F.concat(F.lit("licences conflict: "), "source")).cast("string")).otherwise(F.col("l")[0])
    return one.select("source", F.concat("source", F.lit(" — "), licence).alias("line")).orderBy("source")


def write_atomic(path: str, text: str) -> None:
    """Writes beside ``path`` and renames, so there is either the old file or all of the new one."""
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(fd, "w", encoding="utf-8", newline="\n") as out:
            out.write(text)
        os.replace(tmp, path)
    except BaseException:
        os.unlink(tmp)
        raise


def canonical_document(document: dict) -> dict:
    """A document without what differs between two runs on the same input."""
    out = json.loads(json.dumps(document))
    run = out.get("run", {})
    for k in RUN_KEYS:
        run.pop(k, None)
    for k in INPUT_KEYS:
        run.get("input", {}).pop(k, None)
    return out


def canonical_events(lines: DataFrame) -> DataFrame:
    """Engine events ``value`` as sorted-key JSON without ids that are new in each run; statistics are left out."""
    kind = F.get_json_object("value", "$.event_type")
    return lines.where(F.coalesce(kind, F.lit("")) != "stats").select(canonical_json("value", "flow_id", "flow.reason").alias("value"))


def loss_flags() -> list[Column]:
    """Ten flags of a run's table; null where the stage that would know didn't run."""
    c = F.col
    positive = lambda n: F.when(c(n).isNotNull(), c(n) > 0)
    failed, skipped = F.coalesce(c("rules_failed"), F.lit(0)), F.coalesce(c("rules_skipped"), F.lit(0))
    return [
        F.when(c("input_status").isNotNull(), c("truncated_at").isNotNull()).alias("input_truncated"),
        F.when(c("input_status").isNotNull(), F.coalesce(c("discarded_packets"), F.lit(0)) > 0).alias("multi_datalink_discard"),
        positive("no_flow_match").alias("detection_uncorrelatable"), positive("ambiguous_flow_match").alias("ambiguous_flow_match"), positive("unsupported_transport").alias("unsupported_transport"),
        F.coalesce(positive("tool_failures"), F.lit(False)).alias("tool_failure"), F.when(c("snapshot_resolved").isNotNull(), ~c("snapshot_resolved")).alias("snapshot_missing"),
        positive("identify_suppressed").alias("identify_alert_suppressed"),
        F.when(c("rules_failed").isNotNull() | c("rules_skipped").isNotNull(), (failed > 0) | (skipped > 0)).alias("rules_failed_or_skipped"),
        F.when(c("ja4_status").isNotNull(), c("ja4_status") != "present").alias("ja4_unavailable"),
    ]


#: The counts of a run, in the order of its document; each is null until the stage that measures it has run.
COUNTS = ("flows", "detections", "labels", "unmatched", "unmatched_unsupported_transport", "unmatched_ratio", "identify_alerts_suppressed", "rules_loaded", "rules_failed", "rules_skipped")


def counts_section(correlated: Column, loaded: Column) -> Column:
    """The run's counts from two stages, each with its own columns: null where ``correlated`` or ``loaded`` says that the stage didn't run."""
    of = lambda k: correlated if COUNTS.index(k) < 6 else loaded
    return F.struct(*[F.when(of(k), F.col(k)).alias(k) for k in COUNTS])


def failures(*stages: Column) -> Column:
    """All stages' failures in the order of the stages, each once: the first place of a failure counts."""
    return F.array_distinct(F.concat(*[F.filter(F.coalesce(s, F.array()), lambda f: f.isNotNull()) for s in stages]))


def first_seen(rows: DataFrame, key: list[str], position: str) -> DataFrame:
    """A row per key: ``first`` (the least position that has it) and ``n``; how rows are dealt out doesn't matter."""
    return rows.groupBy(*key).agg(F.min(position).alias("first"), F.count("*").alias("n"))


def most_common(rows: DataFrame, key: list[str], position: str) -> DataFrame:
    """Keys by how often they occur, most first; of equals the one that was seen first."""
    return first_seen(rows, key, position).orderBy(F.desc("n"), "first", *key)


def duration(start: Column, end: Column) -> Column:
    """Seconds between two ISO stamps; null if the end is before the start, see :func:`duration_warning`."""
    us = _between(start, end)
    return F.when(us >= 0, us / F.lit(1_000_000))


def _between(start: Column, end: Column) -> Column:
    return F.unix_micros(F.to_timestamp(end)) - F.unix_micros(F.to_timestamp(start))


def duration_warning(start: Column, end: Column) -> Column:
    """Why there is no duration though both stamps are there; null if there is one."""
    return F.when(_between(start, end) < 0, F.concat(F.lit("the run ends at "), end, F.lit(", before it starts at "), start))


def tiers_unavailable(mode: Column, attested: Column) -> Column:
    tried = F.when(mode == "replay", F.array(F.lit(1))).when(mode == "offline", F.array(F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    return F.array_except(tried, attested)


def summary(names: Iterable[str], most: int = 10) -> str:
    """The first names, joined, and dots if there are more."""
    all_ = list(names)
    return ", ".join(all_[:most]) + (", ..." if len(all_) > most else "")
