"""Rules: parsing their text, admitting or excluding them, and counting every decision once."""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the rule language and of the admission policy.
NON_DETECTING = ("msg", "sid", "rev", "gid", "classtype", "reference", "metadata", "priority", "rem", "target", "noalert", "flow", "threshold", "detection_filter", "tag")
STATE_BITS = ("flowbits", "xbits", "hostbits")
BIT_RECORDING = ("set", "unset", "toggle", "noalert")
CONFIDENCE, SEVERITY = ("high",), ("major", "critical")
EXCLUDED_CLASSTYPES = ("policy-violation",)
OBSERVING_MARKERS = ("ℹ", "👁", "🔒", "🌐", "🤨")
BRAND = "🐾"

_OPTION = r'(?:[^;"\\]|\\.|"(?:[^"\\]|\\.)*")+'
_LEAD = r"^(?:[ \t\n\x0B\f\r\x1C-\x1F]|[\p{Mn}\p{Cf}])*([\p{So}ℹ])"
#: Line numbers of a source that one task puts in order.
BLOCK = 100_000


def state(text: Column) -> Column:
    t = F.trim(text)
    return F.when(t.rlike(r"^#+\s*alert\s"), "disabled").when(t.rlike(r"^alert\s"), "active").otherwise("other")


def sid(text: Column) -> Column:
    """The first ``sid:`` of the text."""
    return F.regexp_extract(text, r"\bsid\s*:\s*(\d+)", 1).try_cast("bigint")


def last_sid(text: Column) -> Column:
    """The last ``sid:…;`` outside quotes: what an engine would load."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', '""')
    return F.try_element_at(F.regexp_extract_all(bare, F.lit(r"\bsid\s*:\s*(\d+)\s*;"), F.lit(1)), F.lit(-1)).try_cast("bigint")


def classtype(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\bclasstype\s*:\s*([A-Za-z0-9._-]+)\s*;", 1), F.lit(""))


def metadata(text: Column, key: str) -> Column:
    """The value of a metadata key over all metadata options; the last one wins."""
    options = F.regexp_extract_all(text, F.lit(r"\bmetadata\s*:\s*([^;]*);"), F.lit(1))
    pairs = F.transform(F.flatten(F.transform(options, lambda o: F.split(o, ","))), lambda p: F.trim(p))
    own = F.filter(pairs, lambda p: F.lower(F.substring_index(p, " ", 1)) == key)
    return F.try_element_at(F.transform(own, lambda p: F.trim(F.regexp_replace(p, r"^\S+\s*", ""))), F.lit(-1))


def metadata_verdict(text: Column) -> Column:
    confidence, severity = F.lower(metadata(text, "confidence")), F.lower(F.coalesce(metadata(text, "signature_severity"), F.lit("")))
    return F.when(confidence.isNull(), "no_confidence").when(~confidence.isin(*CONFIDENCE), "low_confidence").when(~severity.isin(*SEVERITY), "low_severity")


def message(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r'\bmsg\s*:\s*"((?:[^"\\]|\\.)*)"', 1), F.lit(""))


def marker(text: Column, brand: str | None = BRAND) -> Column:
    """The pictograph that leads a rule's message, past the feed's own brand; null where prose leads."""
    said = message(text)
    first = F.nullif(F.regexp_extract(said, _LEAD, 1), F.lit(""))
    if brand is None:
        return first
    after = F.regexp_replace(F.regexp_replace(said, _LEAD, ""), r"^[\s\x{00A0}]*[-–—]?", "")
    return F.when(first == brand, F.nullif(F.regexp_extract(after, _LEAD, 1), F.lit(""))).otherwise(first)


def negates_home_net(text: Column) -> Column:
    """A ``!`` in the header before ``$HOME_NET``, or before a bracket, nested however deep, that holds it.

    A bracket that never closes holds all that follows.  The header's characters
    are folded once: how many brackets are open, which of them is negated, and
    whether a bare term is.
    """
    header = F.substring_index(text, "(", 1)
    tokens = F.regexp_extract_all(header, F.lit(r"(?s)\$HOME_NET(?![A-Za-z0-9_])|."), F.lit(0))
    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("open"), none.alias("negated"), F.lit(False).alias("bang"), F.lit(False).alias("bare"), F.lit(False).alias("hit"))

    def step(a: Column, t: Column) -> Column:
        opens, closes, ends = t == "[", t == "]", t.isin(",", " ", "\t", "[", "]")
        depth = a["open"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        negated = F.when(opens & a["bang"] & a["negated"].isNull(), depth).when(closes & (a["negated"] == a["open"]), none).otherwise(a["negated"])
        bare = (a["bang"] | a["bare"]) & ~ends
        return F.struct(
            depth.alias("open"), negated.alias("negated"), (t == "!").alias("bang"), (bare | (t == "!")).alias("bare"),
            (a["hit"] | ((t == "$HOME_NET") & (bare | a["negated"].isNotNull()))).alias("hit"),
        )

    found = F.aggregate(tokens, start, step, lambda a: a["hit"])
    return F.when(F.contains(header, F.lit("!")) & F.contains(header, F.lit("$HOME_NET")), found).otherwise(F.lit(False))


def options(text: Column) -> Column:
    """A rule's options; null unless the body is well formed: bracketed, quotes and escapes closed."""
    body = F.regexp_extract(text, r"(?s)\((.*)\)\s*$", 1)
    whole = text.rlike(r'(?s)^[^(]*\((?:[^"\\]|\\.|"(?:[^"\\]|\\.)*")*\)\s*$')
    found = F.filter(F.transform(F.regexp_extract_all(body, F.lit(_OPTION), F.lit(0)), lambda o: F.trim(o)), lambda o: o != "")
    return F.when(whole, found)


def address_indicator(text: Column) -> Column:
    """True where no option inspects traffic, so the addresses alone decide; malformed rules are false."""

    def detects(o: Column) -> Column:
        name = F.lower(F.regexp_extract(o, r"^\s*([A-Za-z0-9_.]+)\s*(?::|$)", 1))
        operation = F.lower(F.trim(F.substring_index(F.regexp_replace(o, r"^[^:]*:?", ""), ",", 1)))
        return F.when(name.isin(*STATE_BITS), ~operation.isin(*BIT_RECORDING)).otherwise(~name.isin(*NON_DETECTING))

    found = options(text)
    return F.coalesce((F.size(found) > 0) & ~F.exists(found, detects), F.lit(False))


def logical_lines(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    r"""Joins lines continued with ``\`` per source; ``lines(source, line_no, text)``.

    A comment never begins a continuation, but one inside it is part of it.  A
    source is spread over tasks: by blocks of line numbers, and then by runs.
    """
    slash = F.rtrim("text").endswith("\\")
    comment = F.ltrim("text").startswith("#")
    # (1) Runs of lines that end in a backslash, with the line that ends them, by how many ended before: in earlier blocks, and in the line's own.
    ended = F.when(slash, 0).otherwise(1)
    blocks = lines.withColumns({"__source": F.struct("source"), "__block": F.struct(F.expr(f"line_no div {block}"))})
    before = Window.partitionBy("__source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.groupBy("__source", "__block").agg(F.sum(ended).alias("__n")).select("__source", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__source", "__block").orderBy("line_no")
    runs = blocks.withColumn("__own", F.coalesce(F.sum(ended).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).join(carried, ["__source", "__block"])
    # (2) Within a run all lines from its first rule line on continue; the line before a run's first one has ended.
    within = Window.partitionBy("source", "__run").orderBy("line_no")
    going = runs.withColumn("__run", F.col("__base") + F.col("__own")).withColumn("__on", slash & (F.max((~comment).cast("int")).over(within) == 1))
    starts = going.withColumn("__start", ~F.coalesce(F.lag("__on").over(within), F.lit(False)))
    grouped = starts.withColumn("__group", F.sum(F.col("__start").cast("int")).over(within))
    part = F.struct("line_no", F.when(F.col("__on"), F.regexp_replace("text", r"\\\s*$", "")).otherwise(F.col("text")).alias("text"), F.col("__on").alias("open"))
    joined = grouped.groupBy("source", "__run", "__group").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    last = F.element_at("parts", -1)
    return joined.select("source", F.col("parts")[0]["line_no"].alias("line_no"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), last["open"].alias("dangling"))


def judge(lines: DataFrame, filtered: bool = True, classtypes: tuple = EXCLUDED_CLASSTYPES, markers: tuple = OBSERVING_MARKERS, brand: str = BRAND) -> DataFrame:
    """Rule lines with ``state`` and, for active rules, the one ``verdict`` that counts; null admits."""
    text = F.trim("text")
    verdict = F.coalesce(
        metadata_verdict(text) if filtered else F.lit(None).cast("string"),
        F.when(negates_home_net(text), "unloadable"),
        F.when(F.lower(classtype(text)).isin(*classtypes), "classtype"),
        F.when(marker(text, brand).isin(*markers), "marker"),
    )
    return lines.withColumn("state", state(F.col("text"))).withColumn("verdict", F.when(F.col("state") == "active", verdict))


COUNTED = ("no_confidence", "low_confidence", "low_severity", "unloadable", "classtype", "marker")


def admission(judged: DataFrame) -> DataFrame:
    """Counters per source; fetched equals admitted plus all exclusions."""
    active, ok = F.col("state") == "active", (F.col("state") == "active") & F.col("verdict").isNull()
    return judged.groupBy("source").agg(
        F.count_if(active).alias("fetched"), F.count_if(ok).alias("admitted"), F.count_if(F.col("state") == "disabled").alias("commented"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in COUNTED],
        F.count_if(ok & F.contains("text", F.lit("ja3.hash"))).alias("ja3_admitted"), F.count_if(ok & F.contains("text", F.lit("ja4.hash"))).alias("ja4_admitted"),
    )


def balanced(admissions: DataFrame) -> DataFrame:
    """``admissions`` unchanged; a source whose counters don't add up to what was fetched raises, whatever columns are read.

    Each excluded rule belongs to exactly one counter.
    """
    accounted = sum((F.col(v) for v in COUNTED), F.col("admitted"))
    fault = F.raise_error(F.concat(F.lit("admission of "), "source", F.lit(" does not balance: "), F.col("fetched").cast("string"), F.lit(" fetched, "), accounted.cast("string"), F.lit(" accounted for")))
    return admissions.where(F.when(accounted == F.col("fetched"), F.lit(True)).otherwise(fault.cast("boolean")))


def admitted_markers(judged: DataFrame, brand: str | None = BRAND) -> DataFrame:
    """``source, marker, rules``: what the messages of admitted rules lead with; null where prose does."""
    return judged.where("state = 'active' AND verdict IS NULL").groupBy("source", marker(F.trim("text"), brand).alias("marker")).agg(F.count("*").alias("rules"))


def yields(judged: DataFrame) -> DataFrame:
    """Per source and in ``Total``: active rules, admitted ones, and their percentage (null where there is no active rule)."""
    active = F.col("state") == "active"
    out = judged.rollup("source").agg(F.count_if(active).alias("fetched"), F.count_if(active & F.col("verdict").isNull()).alias("admitted"))
    return out.select(F.coalesce("source", F.lit("Total")).alias("source"), "fetched", "admitted", F.round(100.0 * F.col("admitted") / F.nullif("fetched", F.lit(0)), 4).alias("percent"))


def markers(lines: DataFrame, brand: str | None = BRAND, observing: tuple = OBSERVING_MARKERS) -> DataFrame:
    """``marker, rules, observing`` over all rules, admitted or not."""
    own = lines.groupBy(marker(F.col("text"), brand).alias("marker")).agg(F.count("*").alias("rules"))
    return own.withColumn("observing", F.coalesce(F.col("marker").isin(*observing), F.lit(False)))


def collisions(claims: DataFrame) -> DataFrame:
    """``sid, sources, claimed_by`` of sids that more than one source claims in ``claims(source, sid)``."""
    by = claims.groupBy("sid").agg(F.count_distinct("source").alias("sources"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("claimed_by"))
    return by.where("sources > 1")


def reconciled(have: DataFrame, index: DataFrame) -> DataFrame:
    """``sid, fault``: rules that the index doesn't list, and what it lists without a rule."""
    return have.join(index, "sid", "left_anti").select("sid", F.lit("unattributed").alias("fault")).unionByName(index.join(have, "sid", "left_anti").select("sid", F.lit("phantom").alias("fault")))


def rendered(judged: DataFrame) -> DataFrame:
    """The admitted rules as a snapshot lists them: by source, sid (none: -1) and text."""
    return judged.where("state = 'active' and verdict is null").select("source", F.coalesce(sid(F.col("text")), F.lit(-1)).alias("sid"), "text").orderBy("source", "sid", "text")


def sid_index(judged: DataFrame) -> DataFrame:
    """The sids of each source, and how many of them are address indicators."""
    own = judged.where("state = 'active' and verdict is null").select("source", sid(F.col("text")).alias("sid"), address_indicator(F.col("text")).alias("indicator"))
    return own.where("sid is not null").groupBy("source").agg(F.array_sort(F.collect_set("sid")).alias("sids"), F.count_if("indicator").alias("address_indicators"))


def content_id(files: DataFrame) -> DataFrame:
    """One row: the content address of whole ``files(path, content)``, see :func:`snapshots.address`."""
    from . import snapshots

    return snapshots.address(files.select("path", F.lit(0).alias("at"), "content"))


def content_id_of(files: dict[str, bytes]) -> str:
    """The same for files at hand."""
    h = hashlib.sha256()
    for path, content in sorted(files.items()):
        h.update(path.encode() + b"\0" + struct.pack(">Q", len(content)) + content)
    return h.hexdigest()[:16]


def dataset_files(lines: DataFrame) -> DataFrame:
    """``source, file``: data files that rules load."""
    found = F.regexp_extract_all("text", F.lit(r"\bdataset\s*:[^;]*?\bload\s+([^\s,;]+)"), F.lit(1))
    return lines.select("source", F.explode(found).alias("file")).distinct()


def resolved(files: DataFrame, available: DataFrame) -> DataFrame:
    """``files`` with the one ``folder`` of ``available(folder, file)`` that has each; none or several are failures."""
    by = files.join(available, "file", "left").groupBy("source", "file").agg(F.array_sort(F.collect_set("folder")).alias("f"))
    fault = F.raise_error(F.concat(F.lit("data file in "), F.size("f").cast("string"), F.lit(" folders: "), "file")).cast("string")
    return by.select("source", "file", F.when(F.size("f") == 1, F.col("f")[0]).otherwise(fault).alias("folder"))


def totals(admissions: DataFrame) -> DataFrame:
    """One row: what a snapshot admits over all its sources."""
    return admissions.agg(F.coalesce(F.sum("admitted"), F.lit(0)).alias("total_admitted"), F.coalesce(F.sum("ja4_admitted"), F.lit(0)).alias("total_ja4_admitted"))


def nothing_admitted(admissions: DataFrame) -> DataFrame:
    """``source, message`` of sources that admitted nothing: a failure, with what is likely behind it."""
    message = (
        F.when(F.col("fetched") == 0, "the feed has no active rule").when(F.col("no_confidence") == F.col("fetched"), "no rule has a confidence")
        .when(F.col("unloadable") == F.col("fetched"), "no rule can be loaded").otherwise("every rule was excluded")
    )
    return admissions.where("admitted = 0").select("source", message.alias("message"))
