"""Attaching detections to flows: exactly one flow, or a reason why not.

Both orientations of a flow become equi-join keys, and a detection probes with
one or two keys, so the join is on the full tuple and never on an OR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The ICMP types whose flows carry the paired type, IPv4 and IPv6.
ICMP4 = {0: 8, 8: 0, 9: 10, 10: 9, 13: 14, 14: 13, 15: 16, 16: 15, 17: 18, 18: 17}
ICMP6 = {128: 129, 129: 128, 130: 131, 131: 130, 133: 134, 134: 133, 135: 136, 136: 135, 139: 140, 140: 139, 144: 145, 145: 144}
TRANSPORTS = ("tcp", "udp", "icmp")
TUPLE = ("proto", "src_ip", "src_port", "dst_ip", "dst_port")


def _lookup(table: dict[int, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key.cast("int"))


def counterpart(address: Column, kind: Column) -> Column:
    """The type that a flow of ICMP type ``kind`` carries in its other port column, or null."""
    return F.when(F.contains(address, F.lit(":")), _lookup(ICMP6, kind)).otherwise(_lookup(ICMP4, kind))


def oriented(flows: DataFrame) -> DataFrame:
    """Each flow under the keys of both its orientations; a symmetric tuple has one."""
    same = (F.col("src_ip") == F.col("dst_ip")) & (F.col("src_port") == F.col("dst_port"))
    ends = F.struct(*[F.col(f"{a}_{k}").alias(f"k_{a}_{k}") for a in ("src", "dst") for k in ("ip", "port")])
    back = F.struct(*[F.col(f"{a}_{k}").alias(f"k_{b}_{k}") for a, b in (("dst", "src"), ("src", "dst")) for k in ("ip", "port")])
    keys = F.when(same, F.array(ends)).otherwise(F.array(ends, back))
    return flows.select("uid", F.col("proto").alias("k_proto"), "ts_first_us", "ts_last_us", F.explode(keys).alias("k")).select("uid", "k_proto", "ts_first_us", "ts_last_us", "k.*")


def probes(dets: DataFrame) -> DataFrame:
    """Each detection with the one or two responder ports under which its flow may be found."""
    other = F.when(F.col("proto") == "icmp", counterpart(F.col("src_ip"), F.col("src_port")))
    ports = F.array_distinct(F.array_compact(F.array(F.col("dst_port").cast("int"), other)))
    return dets.where(_supported()).select("did", "ts_us", *TUPLE[:-1], F.explode(ports).alias("probe_port"))


def _supported() -> Column:
    """Whether the transport can be compared at all; an empty one is a defect, not a transport."""
    return (F.col("proto") == "") | F.lower("proto").isin(*TRANSPORTS)


def candidates(dets: DataFrame, flows: DataFrame) -> DataFrame:
    """``did, ts_us, uid, ts_first_us, ts_last_us``: all flows that a detection's tuple fits, each once."""
    on = [F.col("proto") == F.col("k_proto"), F.col("src_ip") == F.col("k_src_ip"), F.col("src_port") == F.col("k_src_port"), F.col("dst_ip") == F.col("k_dst_ip"), F.col("probe_port") == F.col("k_dst_port")]
    return probes(dets).join(oriented(flows), on).select("did", "ts_us", "uid", "ts_first_us", "ts_last_us")


KEY = [f"k_{c}" for c in TUPLE]
#: Where a detection meets flows: its tuple, but all ports of an ICMP type at once, as it may ask for two of them.
MEET = [*KEY[:-1], "k_door"]
#: Flows that meet under one key beyond which they aren't held in one row; microseconds of the slots in which such a tuple is dealt to tasks.
HOT, SLOT = 4096, 3_600_000_000


def _met(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("k_door", F.when(F.col("k_proto") == "icmp", -1).otherwise(F.col("k_dst_port").cast("int")))


def _meeting(dets: DataFrame) -> DataFrame:
    """Detections with the key under which they meet flows; the last part is null for those that can't be placed."""
    door = F.when(_supported(), F.when(F.col("proto") == "icmp", -1).otherwise(F.col("dst_port").cast("int")))
    return dets.withColumns({**{f"k_{c}": F.col(c) for c in TUPLE[:-1]}, "k_door": door})


def _asks(door: Column) -> Column:
    """Whether a detection asks for the flows behind this port."""
    other = F.when(F.col("proto") == "icmp", counterpart(F.col("src_ip"), F.col("src_port")))
    return (door["port"] == F.col("dst_port").cast("int")) | (door["port"] == other)


def candidate_counts(dets: DataFrame, flows: DataFrame) -> DataFrame:
    """``did, candidates, first_uid`` of the detections (unique ``did``) that have :func:`candidates`: how many flows, and the least.

    Flows are counted by tuple before detections meet them, so no pair is made.
    Two ports that one detection asks for never lead to the same flow: it would
    need the same port at both its ends, and then they are one port.
    """
    # One exchange serves all three groupings; the last one lets adaptive execution split the detections of a frequent tuple.
    met = _met(oriented(flows)).select(*MEET, "k_dst_port", "uid").repartition(*MEET)
    per = met.distinct().groupBy(*MEET, "k_dst_port").agg(F.count("*").alias("n"), F.min("uid").alias("lo"))
    doors = per.groupBy(*MEET).agg(F.collect_list(F.struct(F.col("k_dst_port").alias("port"), "n", "lo")).alias("doors")).repartition(*MEET)
    found = _meeting(dets).join(doors, MEET).select("did", F.filter("doors", _asks).alias("hit")).where(F.size("hit") > 0)
    total = F.aggregate("hit", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    return found.select("did", total.alias("candidates"), F.array_min(F.transform("hit", lambda x: x["lo"])).alias("first_uid"))


def _spans(keyed: DataFrame) -> DataFrame:
    """Per meeting key its ports, each with the least and greatest uid and ``spans``: what is open from each flow's beginning on.

    A span has the flow that ends last of those begun, and the latest end of
    any other: a time before neither is within several, before the first only
    it is within just that flow.
    """
    within = Window.partitionBy(*MEET, "k_dst_port").orderBy("ts_first_us", "ts_last_us", "uid")
    so_far, before = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(Window.unboundedPreceding, -1)
    sound = (F.col("ts_first_us") <= F.col("ts_last_us")) & F.col("uid").isNotNull()
    end = F.when(sound, F.struct("ts_last_us", "uid"))
    tops = _met(keyed).repartition(*MEET).withColumns({"top": F.max(end).over(so_far), "was": F.max(end).over(before), "n": F.row_number().over(within)})
    # The end that doesn't lead is the lesser of the new one and the one that led, unless both are the same flow's.
    lesser = F.when(sound & (F.col("was.uid") != F.col("uid")), F.least("ts_last_us", "was.ts_last_us"))
    span = F.when(sound, F.struct("ts_first_us", "n", F.col("top.ts_last_us").alias("last"), F.col("top.uid").alias("uid"), F.max(lesser).over(so_far).alias("second")))
    per = tops.select(*MEET, "k_dst_port", "uid", span.alias("span")).groupBy(*MEET, "k_dst_port").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"), F.sort_array(F.collect_list("span")).alias("spans"))
    return per.groupBy(*MEET).agg(F.collect_list(F.struct(F.col("k_dst_port").alias("port"), "lo", "hi", "spans")).alias("__doors")).repartition(*MEET)


def _looked_up(dets: DataFrame, doors: DataFrame, hot: int) -> DataFrame:
    """``dets`` with ``lo, hi, in_lo, in_hi``: least and greatest uid of all its candidates and of those that contain it (any two of several)."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(max(hot, 1).bit_length()))])

    def at(door: Column) -> Column:
        # Spans begun, by halving: a position is taken if its span has begun; past the end there is none.
        begun = F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.get(door["spans"], p + s - 1)["ts_first_us"] <= F.col("ts_us"), p + s).otherwise(p))
        return F.struct(door["lo"].alias("lo"), door["hi"].alias("hi"), F.get(door["spans"], begun - 1).alias("at"))

    def judged(x: Column) -> Column:
        one, several = x["at"]["last"] >= F.col("ts_us"), x["at"]["second"] >= F.col("ts_us")
        inside = [F.when(one, F.when(several, x[k]).otherwise(x["at"]["uid"])).alias(f"in_{k}") for k in ("lo", "hi")]
        return F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), *inside)

    found = _meeting(dets).join(doors, MEET, "left").select(*dets.columns, F.transform(F.transform(F.filter("__doors", _asks), at), judged).alias("__found"))
    ends = {k: end(F.col("__found")[k]) for k, end in (("lo", F.array_min), ("hi", F.array_max), ("in_lo", F.array_min), ("in_hi", F.array_max))}
    return found.withColumns(ends).drop("__found")


def _asked(dets: DataFrame) -> DataFrame:
    """Probes under the names of the flows' keys."""
    return probes(dets).select("did", "ts_us", *[F.col("probe_port" if c == "dst_port" else c).alias(f"k_{c}") for c in TUPLE])


def _swept(asked: DataFrame, keyed: DataFrame, slot_us: int) -> DataFrame:
    """``did, lo, hi, in_lo, in_hi`` for tuples with too many flows for a row; a detection may have a row per key.

    Along a tuple's time the number of open flows is a running sum, and the
    exclusive or of their hashes is the hash of the one that is open when it is
    the only one; where several are, ``in_lo`` and ``in_hi`` are any two.  Sums
    are taken slot by slot and carried from slot to slot, so a tuple with any
    number of flows is spread over tasks; the one flow is looked up by its hash
    and its own times.
    """
    moment = lambda t, kind, step, mark: F.struct(F.col(t).alias("ts_us"), F.lit(kind).alias("kind"), F.lit(step).alias("step"), mark.alias("mark"))
    none = F.lit(0).cast("bigint")
    # Beginnings count before detections of the same time, ends after them; flows that never contain anything change nothing.
    opens = F.when(F.col("ts_first_us") <= F.col("ts_last_us"), F.array(moment("ts_first_us", 0, 1, F.xxhash64("uid")), moment("ts_last_us", 2, -1, F.xxhash64("uid"))))
    edges = keyed.select(*KEY, "uid", F.lit(None).cast("bigint").alias("did"), F.explode(F.coalesce(opens, F.array(moment("ts_first_us", 0, 0, none)))).alias("m")).select(*KEY, "uid", "did", "m.*")
    events = edges.unionByName(asked.select(*KEY, F.lit(None).cast("string").alias("uid"), "did", "ts_us", F.lit(1).alias("kind"), F.lit(0).alias("step"), none.alias("mark"))).withColumn("slot", F.coalesce(F.floor(F.col("ts_us") / slot_us), none))
    by_slot = events.groupBy(*KEY, "slot").agg(F.sum("step").alias("step"), F.expr("bit_xor(mark)").alias("mark"), F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    before = Window.partitionBy(*KEY).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*KEY)
    carried = by_slot.select(
        *KEY, "slot", F.coalesce(F.sum("step").over(before), none).alias("open"), F.coalesce(F.expr("bit_xor(mark)").over(before), none).alias("which"), F.min("lo").over(whole).alias("lo"), F.max("hi").over(whole).alias("hi")
    )
    within = Window.partitionBy(*KEY, "slot").orderBy("ts_us", "kind")
    running = events.withColumns({"n": F.sum("step").over(within), "x": F.expr("bit_xor(mark)").over(within)}).where("did IS NOT NULL")
    at = running.join(carried, [*KEY, "slot"]).select(*KEY, "did", "ts_us", "lo", "hi", (F.col("n") + F.col("open")).alias("inside"), F.col("x").bitwiseXOR(F.col("which")).alias("mark"))
    known = keyed.select(*KEY, F.xxhash64("uid").alias("mark"), "uid", "ts_first_us", "ts_last_us")
    only = at.where("inside = 1").join(known, [*KEY, "mark"]).where("ts_us BETWEEN ts_first_us AND ts_last_us").select("did", "lo", "hi", F.col("uid").alias("in_lo"), F.col("uid").alias("in_hi"))
    several = F.col("inside") > 1
    return at.where("inside <> 1").select("did", "lo", "hi", F.when(several, F.col("lo")).alias("in_lo"), F.when(several, F.col("hi")).alias("in_hi")).unionByName(only)


def place(dets: DataFrame, flows: DataFrame, hot: int = HOT, slot_us: int = SLOT) -> DataFrame:
    """``dets`` (unique ``did``) with ``uid`` or ``reason``: the placement truth table.

    A lone candidate is taken whatever the clock says; of several, the one that
    contains the detection (both ends inclusive), if it is only one.  Flows have
    a uid each.  No pair of detection and candidate is made: a detection looks
    its time up among its tuple's flows, and passes one exchange.  Tuples with
    more than ``hot`` flows, if there are any (a job counts them), are swept
    along their time instead; the rows are the same.
    """
    keyed = oriented(flows)
    crowded = _met(keyed).groupBy(*MEET).agg(F.count("*").alias("n")).where(F.col("n") > hot).select(*MEET)
    if crowded.isEmpty():
        seen = _looked_up(dets, _spans(keyed), hot)
    else:
        own = _meeting(dets).join(crowded, MEET, "left_semi").select(*dets.columns)
        many = _swept(_asked(own), _met(keyed).join(crowded, MEET, "left_semi").drop("k_door"), slot_us)
        # A flow reached under two keys counts once: its uids are compared, not its rows.
        ends = many.groupBy("did").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("in_lo").alias("in_lo"), F.max("in_hi").alias("in_hi"))
        few = _meeting(dets).join(crowded, MEET, "left_anti").select(*dets.columns)
        seen = _looked_up(few, _spans(_met(keyed).join(crowded, MEET, "left_anti").drop("k_door")), hot).unionByName(own.join(ends, "did", "left"))
    uid = F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("in_lo") == F.col("in_hi"), F.col("in_lo"))
    reason = F.when(~_supported(), "unsupported_transport").when(F.col("lo").isNull(), "no_flow_match").when(uid.isNull(), "ambiguous_flow_match")
    how = F.when(reason.isNull(), F.when(F.col("lo") == F.col("hi"), "lone").otherwise("clock"))
    return seen.withColumns({"uid": uid, "reason": reason, "how": how}).drop("lo", "hi", "in_lo", "in_hi")


def counts(placed: DataFrame, flows: DataFrame) -> DataFrame:
    """One row: totals and the ratio that the gate judges; no correlatable detection is no loss."""
    d = placed.agg(
        F.count("*").alias("detections_total"), F.count("reason").alias("unmatched"), F.count_if(F.col("reason") == "unsupported_transport").alias("unsupported_transport"),
        F.count_distinct("uid").alias("labels"),
    )
    n = F.col("detections_total") - F.col("unsupported_transport")
    ratio = F.when(n == 0, 0.0).otherwise((F.col("unmatched") - F.col("unsupported_transport")) / n)
    return d.crossJoin(flows.agg(F.count("*").alias("flows_total"))).withColumns({"correlatable_total": n, "unmatched_ratio": F.round(ratio, 9)})


class Unmatched(RuntimeError):
    """More detections than the threshold allows could not be placed."""


def check_threshold(value: float) -> float:
    """A share between 0 and 1; anything else would switch the gate off."""
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not 0.0 <= value <= 1.0:
        raise ValueError(f"unmatched threshold {value!r} is not a share between 0 and 1")
    return float(value)


def gate(row, threshold: float = 0.01) -> list[str]:
    """Warnings for a row of :func:`counts`; raises above the threshold, is silent without loss."""
    check_threshold(threshold)
    if not row["unmatched"]:
        return []
    lost, unsupported = row["unmatched"] - row["unsupported_transport"], row["unsupported_transport"]
    aside = f", plus {unsupported} on a transport that no flow can have" if unsupported else ""
    said = f"{lost} of {row['correlatable_total']} correlatable detections ({row['unmatched_ratio']:.2%}) have no one flow{aside}"
    if row["unmatched_ratio"] > threshold:
        raise Unmatched(f"{said}; above the {threshold:.2%} threshold")
    return [f"{said}; they are listed as unmatched and carry no label"]


def in_windows(windows: DataFrame, dets: DataFrame, keys: list[str], bucket: int) -> DataFrame:
    """``uid, detections``: how many of ``dets(did, ts_us, *keys)`` fall into each window ``(uid, a, b, *keys)``, ends included.

    Windows are dealt to the buckets of time that they touch, so keys and
    bucket join for equality; a key with many detections is many buckets.
    """
    slot = lambda c: F.floor(F.col(c) / bucket).cast("bigint")
    dealt = windows.withColumn("slot", F.explode(F.sequence(slot("a"), slot("b"))))
    hit = dealt.join(dets.withColumn("slot", slot("ts_us")), [*keys, "slot"]).where("ts_us between a and b").groupBy("uid").agg(F.count("*").alias("detections"))
    return windows.select("uid").join(hit, "uid", "left").select("uid", F.coalesce("detections", F.lit(0)).cast("bigint").alias("detections"))
