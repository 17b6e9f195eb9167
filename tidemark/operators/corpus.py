"""Reports and gates over many runs: triage, prevalence, allow-lists, differences between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UBIQUITOUS = 2 / 3
CEILING = 10


def totals(rows: DataFrame) -> DataFrame:
    """Entries by (source, sid, basis, classtype), and the runs in which each was seen."""
    return rows.groupBy("source", "sid", "label_basis", "classtype").agg(F.count("*").alias("entries"), F.count_distinct("run_id").alias("runs"))


def prevalence(seen: Column, captures: Column, snapshots: Column) -> Column:
    """``one``, ``EVERY`` (two thirds or more), or blank; blank too if runs used different snapshots."""
    return F.when((captures <= 0) | (snapshots > 1), "").when(seen == 1, "one").when(seen / captures >= UBIQUITOUS, "EVERY").otherwise("")


def concerns(runs: DataFrame) -> DataFrame:
    """``concerns``: why a run saw less than it seems to."""
    found = F.array_compact(F.array(
        F.when(F.col("rules_loaded") != F.col("total_admitted"), F.lit("partial ruleset")),
        F.when(F.col("input_status") != "complete", F.lit("partial input")),
        F.when(F.col("unmatched") > 0, F.lit("unmatched detections")),
        F.when(F.col("discarded_packets") > 0, F.lit("discarded packets")),
    ))
    return runs.withColumn("concerns", found)


def warning_heads(warnings: DataFrame) -> DataFrame:
    """Warnings by what stands before the first colon, 70 characters at most."""
    return warnings.groupBy(F.substring(F.split("warning", ":")[0], 1, 70).alias("head")).agg(F.count("*").alias("warnings"))


def review(seen: DataFrame, tolerated: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """``source, sid, label_basis, fault``: entries that nobody tolerates, tolerated ones that grew too far, and stale ones.

    What is tolerated on one basis says nothing of another.
    """
    both = seen.join(tolerated, ["source", "sid", "label_basis"], "full_outer")
    fault = F.when(F.col("count_when_measured").isNull(), "offender").when(F.col("entries").isNull(), "stale").when(F.col("entries") > ceiling * F.col("count_when_measured"), "above ceiling")
    return both.select("source", "sid", "label_basis", fault.alias("fault")).where("fault is not null")


def unsound(runs: DataFrame) -> DataFrame:
    """``run_id, reason`` of runs ``(run_id, state, rules_loaded, total_admitted, input_status)`` that looked at less than they claim.

    A count that is missing is no evidence.  A run without labels isn't unsound
    but failed, and raises: its silence would read as an empty result.
    """
    died = F.raise_error(F.concat(F.lit("run "), F.col("run_id"), F.lit(" wrote no labels: "), "state")).cast("string")
    reason = (
        F.when(F.col("state") != "labelled", died)
        .when(~F.col("rules_loaded").eqNullSafe(F.col("total_admitted")) | F.col("rules_loaded").isNull(), F.concat(F.lit("loaded "), F.coalesce(F.col("rules_loaded").cast("string"), F.lit("an unknown number")), F.lit(" of "), F.coalesce(F.col("total_admitted").cast("string"), F.lit("unknown")), F.lit(" rules")))
        .when(~F.col("input_status").eqNullSafe(F.lit("complete")), F.concat(F.lit("input is "), F.coalesce("input_status", F.lit("unknown"))))
    )
    return runs.select("run_id", reason.alias("reason")).where("reason IS NOT NULL")


#: Parts of the expected number that is the floor; share of the fetched rules that is the ceiling.
FLOOR, SHARE = 10, 0.05


def marker_gate(counts: DataFrame, markers: DataFrame, expected: DataFrame, known: DataFrame, floor: int = FLOOR, share: float = SHARE) -> DataFrame:
    """``source, fault, detail`` where a feed's markers no longer do what its policy relies on.

    ``counts(source, fetched, marker)`` are admission counters, ``markers(source,
    marker, rules)`` what admitted rules lead with, ``expected(source,
    excluded)`` what the policy excluded when it was written, ``known(marker)``
    the reviewed markers.  Nothing excluded, less than a tenth of what was
    expected, more than a twentieth of the feed, a marker that nobody reviewed,
    and a source that isn't there at all are faults; only the first of the
    counts' faults is said of a source.
    """
    both = expected.join(counts, "source", "left")
    least, most = F.floor(F.col("excluded") / floor), F.floor(F.col("fetched") * F.lit(share))
    fault = (
        F.when(F.col("fetched").isNull(), "not in the snapshot").when(F.col("marker") == 0, "nothing excluded")
        .when(F.col("marker") < least, "under the floor").when(F.col("marker") > most, "over the ceiling")
    )
    detail = F.when(F.col("marker") < least, F.concat("marker", F.lit(" of "), least)).when(F.col("marker") > most, F.concat("marker", F.lit(" of "), most))
    moved = both.select("source", fault.alias("fault"), detail.cast("string").alias("detail")).where("fault IS NOT NULL")
    fresh = markers.where("marker IS NOT NULL").join(expected.select("source"), "source", "left_semi").join(known, "marker", "left_anti")
    return moved.unionByName(fresh.select("source", F.lit("marker nobody reviewed").alias("fault"), F.concat("marker", F.lit(": "), F.col("rules").cast("string")).alias("detail")))


def liveness(builds: DataFrame, now_us: int, days: float) -> DataFrame:
    """Per workflow, the age in days of its newest success, and whether that is too old (or there is none)."""
    newest = builds.groupBy("workflow").agg(F.max(F.when(F.col("conclusion") == "success", F.col("created_us"))).alias("newest"))
    age = (F.lit(now_us) - F.col("newest")) / 86_400_000_000
    return newest.select("workflow", F.round(age, 6).alias("age_days"), (F.col("newest").isNull() | (age > days)).alias("stale"))


#: Files that differ from run to run, and the ending of files that a killed run left half written.
EXCLUDED, PARTIAL = ("zeek/packet_filter.log", "suricata/suricata.log"), ".partial"


def comparable(files: DataFrame) -> DataFrame:
    """``files(name, ...)`` that two runs over one capture must have in common, by their path within the run."""
    return files.where(~F.col("name").isin(*EXCLUDED) & ~F.endswith("name", F.lit(PARTIAL)))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``name, kind, first``: files of two runs that differ, and the first record at which they do.

    Both have ``name, pos, record``; files that needn't be equal are left out.
    """
    left, right = comparable(left), comparable(right)
    a, b = left.withColumnRenamed("record", "a"), right.withColumnRenamed("record", "b")
    pairs = a.join(b, ["name", "pos"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    first = pairs.groupBy("name").agg(F.min("pos").alias("first"))
    names = left.select("name").distinct().withColumn("l", F.lit(True)).join(right.select("name").distinct().withColumn("r", F.lit(True)), "name", "full_outer")
    kind = F.when(F.col("r").isNull(), "only left").when(F.col("l").isNull(), "only right").otherwise("differs")
    return names.join(first, "name").select("name", kind.alias("kind"), "first")


def bag_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records of which one side has more, however they are ordered."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
