"""The label store: identities, attested tiers, authoritative runs, merged labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.net import packed
from . import gates

TRANSPORTS = ("tcp", "udp", "icmp")
TABLES = ("captures", "flow_labels", "unmatched")


#: The first and the last microsecond that have a four-digit year.
FIRST_US, LAST_US = -62_135_596_800_000_000, 253_402_300_799_999_999


def iso(us: Column) -> Column:
    """Microseconds as the one timestamp format, whatever the session's time zone; a time outside the years 1 to 9999 raises."""
    fault = F.raise_error(F.concat(us.cast("string"), F.lit(" microseconds are no UTC time")))
    at = F.when((us >= FIRST_US) & (us <= LAST_US), us).when(us.isNotNull(), fault.cast("bigint"))
    utc = F.timestamp_add("MICROSECOND", at, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def micros(seconds: Column) -> Column:
    """Epoch seconds to microseconds, half to even; a plain cast would cut them off."""
    return F.rint(seconds * 1e6).cast("bigint")


def run_id(capture: Column, mode: Column, started: Column, version: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", capture, mode, started, version), 256), 1, 16)


def flow_key(capture: Column, ip_proto: Column) -> Column:
    """Identity of a flow with columns proto, src_*, dst_*, ts_first_us: its endpoints in order, never its uid.

    Endpoints are ordered by the bytes of their address, then by port; addresses are in their canonical text.
    """

    def end(p: str) -> Column:
        ip, port = F.col(f"{p}_ip"), F.col(f"{p}_port")
        return F.struct(packed(ip).alias("packed"), port.alias("port"), F.concat(ip, F.lit(":"), port.cast("string")).alias("text"))

    a, b = end("src"), end("dst")
    return F.substring(F.sha2(F.concat_ws("|", capture, F.lower("proto"), ip_proto.cast("string"), F.least(a, b)["text"], F.greatest(a, b)["text"], iso(F.col("ts_first_us"))), 256), 1, 16)


def attest(runs: DataFrame) -> DataFrame:
    """``tiers_attested`` and ``notes`` from positive evidence; a null count is no evidence.

    Tier 2 needs rules_loaded = total_admitted, neither null nor 0; tier 1 a
    replay without a failure of the device.
    """
    two = F.coalesce((F.col("rules_loaded") == F.col("total_admitted")) & (F.col("rules_loaded") > 0), F.lit(False))
    one = F.col("mode").isin("replay", "both") & ~F.coalesce(F.col("device_failed"), F.lit(False))
    tried2 = F.col("mode").isin("offline", "both")
    tiers = F.array_compact(F.array(F.when(one, F.lit(1)), F.when(two & tried2, F.lit(2))))
    notes = F.array_compact(F.array(
        F.when(F.col("mode").isin("replay", "both") & ~one, F.lit("tier 1: the device failed")),
        F.when(tried2 & (F.col("rules_loaded").isNull() | F.col("total_admitted").isNull()), F.lit("tier 2: a count is missing"))
        .when(tried2 & ~two, F.lit("tier 2: a partial ruleset")),
    ))
    return runs.withColumns({"tiers_attested": tiers, "attestation_notes": notes})


def authoritative(runs: DataFrame, exclusions: DataFrame) -> DataFrame:
    """``capture_sha256, tier, run_id``: the newest run, not excluded, that attests each tier of a capture."""
    live = runs.join(exclusions, "run_id", "left_anti").select("capture_sha256", "run_id", "finished_us", F.explode("tiers_attested").alias("tier"))
    w = Window.partitionBy("capture_sha256", "tier").orderBy(F.col("finished_us").desc_nulls_last(), F.col("run_id").desc())
    return live.withColumn("r", F.row_number().over(w)).where("r = 1").select("capture_sha256", "tier", "run_id")


def compose(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Merged sources per flow: of each run only the tiers for which it is authoritative.

    ``rows(run_id, capture_sha256, flow_key, tier, source, sid, value)``.  Tiers
    that disagree about a single value are a conflict, not a choice.
    """
    own = rows.join(chosen.select("run_id", "tier"), ["run_id", "tier"], "left_semi")
    return own.groupBy("capture_sha256", "flow_key").agg(
        F.min("tier").alias("best_tier"), F.array_sort(F.collect_set("sid")).alias("sids"), F.count("*").alias("sources"),
        F.count_distinct("run_id").alias("runs"), (F.count_distinct("value") > 1).alias("conflict"),
    )


def committed(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of runs that are committed: the run's own row is the commit marker."""
    return rows.join(runs.select("run_id"), "run_id", "left_semi")


def merge(rows: DataFrame, chosen: DataFrame, strict: bool = True) -> DataFrame:
    """Merged labels per flow, from whole label rows of runs.

    ``rows(run_id, capture_sha256, flow_key, labels, sources)`` has the arrays of
    label documents: labels of name, value, tier and sids; sources whose first
    fields are tier, source, sid, rev and direction.  Of each run only those
    tiers count for which it is authoritative (``chosen``): the sources of those
    tiers, all of them, in their one order; of each name the entry of the least
    tier, with the sids of all its entries.  ``best_tier`` is the least of the
    sources.  Where entries of a name differ in value that is a conflict:
    ``strict`` raises, else ``conflicts`` has the names.

    A flow has a row per tier at most, as each tier has one run, so groups are small.
    """
    tiers = chosen.groupBy("capture_sha256", "run_id").agg(F.collect_set(F.col("tier").cast("int")).alias("__tiers"))
    mine = lambda c: F.filter(c, lambda x: F.array_contains("__tiers", x["tier"].cast("int")))
    own = rows.join(tiers, ["capture_sha256", "run_id"]).select("capture_sha256", "flow_key", "run_id", mine("sources").alias("sources"), mine("labels").alias("labels"))
    every = own.where(F.size("sources") > 0).groupBy("capture_sha256", "flow_key").agg(
        F.sort_array(F.flatten(F.collect_list("sources"))).alias("sources"), F.flatten(F.collect_list("labels")).alias("__all"), F.array_sort(F.collect_set("run_id")).alias("runs")
    )
    names = F.array_sort(F.array_distinct(F.transform("__all", lambda x: x["name"])))

    def merged(name: Column) -> Column:
        # One pass over the flow's entries: the least tier's value so far, all sids, and whether another value was seen.
        start = F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("int").alias("tier"), F.array().cast("array<bigint>").alias("sids"), F.lit(False).alias("conflict"))

        def step(a: Column, x: Column) -> Column:
            tier, less = x["tier"].cast("int"), a["tier"].isNull() | (x["tier"].cast("int") < a["tier"])
            return F.struct(
                F.when(less, x["value"]).otherwise(a["value"]).alias("value"), F.when(less, tier).otherwise(a["tier"]).alias("tier"), F.array_union(a["sids"], x["sids"].cast("array<bigint>")).alias("sids"),
                (a["conflict"] | (a["tier"].isNotNull() & ~a["value"].eqNullSafe(x["value"]))).alias("conflict"),
            )

        return F.aggregate(F.filter("__all", lambda x: x["name"] == name), start, step, lambda a: F.struct(name.alias("name"), a["value"].alias("value"), a["tier"].alias("tier"), F.array_sort(a["sids"]).alias("sids"), a["conflict"].alias("conflict")))

    out = every.withColumn("__merged", F.transform(names, merged))
    conflicts = F.transform(F.filter("__merged", lambda x: x["conflict"]), lambda x: x["name"])
    plain = F.transform("__merged", lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"), x["tier"].alias("tier"), x["sids"].alias("sids")))
    fault = F.raise_error(F.concat(F.lit("tiers disagree on "), F.array_join(conflicts, ", "), F.lit(" of flow "), F.col("flow_key")))
    labels = F.when(F.size(conflicts) > 0, fault.cast("array<struct<name: string, value: string, tier: int, sids: array<bigint>>>")).otherwise(plain) if strict else plain
    return out.select("capture_sha256", "flow_key", F.array_min(F.transform("sources", lambda x: x["tier"].cast("int"))).alias("best_tier"), labels.alias("labels"), "sources", "runs", conflicts.alias("conflicts"))


def flow_gates(allow_missing_origin: bool = False) -> list[gates.Gate]:
    """What a load of flow labels refuses: rows of transports whose flows have no identity of their own, and rows without an origin.

    The first are left out and counted.  One of the second refuses the whole
    load, unless they are allowed; they are counted either way.
    """
    return [
        gates.Gate("unsupported transport", ~F.coalesce(F.col("proto"), F.lit("")).isin(*TRANSPORTS)),
        gates.Gate("without origin", uri_fault(F.col("uri")).isNotNull(), drop=False, most=None if allow_missing_origin else 0),
    ]


def load(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame], runs: DataFrame, refuse: dict[str, list[gates.Gate]] | None = None) -> bool:
    """Loads a run's tables under ``root``, its row in ``runs`` last; False if the run is there already.

    A half-loaded run is replaced: each table has a partition per run.  The
    gates of ``refuse`` (by table) count while their table is written and are
    judged before the run's row, which has the counts as ``refused``; a refused
    run leaves no row, so nothing of it can be read.
    """
    try:
        if spark.read.parquet(f"{root}/runs").where(F.col("run_id") == run).limit(1).count():
            return False
    except Exception as e:  # no run yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    counts: dict[str, int] = {}
    for name in TABLES:
        own = gates.Watched(tables[name], (refuse or {}).get(name, []))
        own.df.write.mode("overwrite").parquet(f"{root}/{name}/run_id={run}")
        if own.gates:
            counts |= {f"{name}: {k}": n for k, n in own.check().items()}
    said = F.create_map(*[F.lit(x) for kv in sorted(counts.items()) for x in kv]) if counts else F.create_map().cast("map<string, int>")
    runs.withColumns({"run_id": F.lit(run), "refused": said.cast("map<string, bigint>")}).write.mode("append").parquet(f"{root}/runs")
    return True


def uri_fault(uri: Column) -> Column:
    """What is wrong with a capture's gs:// URI, the first fault only; null if nothing is."""
    bucket = F.split_part(F.regexp_replace(uri, "^gs://", ""), F.lit("/"), F.lit(1))
    name = F.regexp_replace(uri, "^gs://[^/]*/?", "")
    return (
        F.when(uri.isNull() | (uri == ""), "empty").when(~F.startswith(uri, F.lit("gs://")), "scheme").when(F.octet_length(uri) > 1024, "long")
        .when(uri.rlike(r"[\x00-\x1F\x7F]"), "control character").when(bucket == "", "bucket").when((name == "") | F.endswith(name, F.lit("/")), "object")
    )


def coverage(flows: DataFrame) -> DataFrame:
    """Per capture of ``flows(capture, proto, uri)``: all, those whose transport the store refuses, those without an origin, and of these the ones whose URI names no object."""
    fault = uri_fault(F.col("uri"))
    refused = F.count_if(~F.col("proto").isin(*TRANSPORTS)).alias("refused")
    return flows.groupBy("capture").agg(F.count("*").alias("flows"), refused, F.count_if(fault.isNotNull()).alias("without_origin"), F.count_if(fault == "object").alias("bad_object"))


def collection_order(rows: DataFrame) -> DataFrame:
    """Rows of a collection in its one order: by capture, first packet and flow key."""
    return rows.orderBy("capture_sha256", "ts_first", "flow_key")
