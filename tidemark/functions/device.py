"""Fields of a device's threat log, and of engine records, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of protocols and directions, and the subtypes that may label.
PROTO_ALIASES = {"ipv6-icmp": "icmp", "icmpv6": "icmp"}
TO_SERVER, TO_CLIENT = ("client-to-server", "c2s", "to_server"), ("server-to-client", "s2c", "to_client")
LABELLING = ("", "vulnerability", "spyware", "virus", "wildfire-virus")


def proto(x: Column) -> Column:
    low = F.lower(F.trim(x))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in PROTO_ALIASES.items() for v in kv]), low), low)


def direction(x: Column) -> Column:
    low = F.lower(F.trim(x))
    return F.when(low.isin(*TO_SERVER), "to_server").when(low.isin(*TO_CLIENT), "to_client").otherwise("unknown")


def port(x: Column) -> Column:
    """Digits, else 0."""
    return F.coalesce(F.when(F.trim(x).rlike(r"^\d+$"), F.trim(x).try_cast("int")), F.lit(0))


def threat_id(text: Column, tid: Column) -> Column:
    """Digits, the digits in the last brackets, else ``tid``; null if none has any."""
    t = F.trim(text)
    plain = F.when(t.rlike(r"^\d+$"), t.try_cast("bigint"))
    bracketed = F.nullif(F.regexp_extract(t, r"\(\s*(\d+)\s*\)$", 1), F.lit("")).try_cast("bigint")
    return F.coalesce(plain, bracketed, F.when(F.trim(tid).rlike(r"^\d+$"), F.trim(tid).try_cast("bigint")))


def threat_name(text: Column) -> Column:
    """The text without brackets at its end; the text itself if nothing else is there; ``unnamed`` if empty."""
    t = F.trim(text)
    bare = F.trim(F.regexp_replace(t, r"\s*\([^()]*\)$", ""))
    return F.coalesce(F.nullif(bare, F.lit("")), F.nullif(t, F.lit("")), F.lit("unnamed"))


def ruleset(content: Column, config: Column) -> Column:
    c = F.nullif(F.trim(content), F.lit(""))
    return F.when(c.isNull(), "unknown-content").otherwise(F.concat(c, F.coalesce(F.concat(F.lit("/config-"), F.nullif(F.trim(config), F.lit(""))), F.lit(""))))


def received_us(x: Column) -> Column:
    """Either of the device's two time formats, as UTC microseconds; 0 if it is neither."""
    t = F.trim(x)
    return F.coalesce(F.unix_micros(F.coalesce(F.try_to_timestamp(t, F.lit("yyyy/MM/dd HH:mm:ss")), F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))), F.lit(0))


def admits(subtype: Column) -> Column:
    return F.coalesce(F.lower(F.trim(subtype)), F.lit("")).isin(*LABELLING)


def counter_delta(before: Column, after: Column) -> Column:
    """How much a counter grew; one that was reset grew by nothing that is known."""
    return F.greatest(F.lit(0), after - before)


def run_directory(name: Column) -> Column:
    bare = F.ltrim(F.regexp_replace(name, r"(?i)(\.(gz|pcapng|pcap))+$", ""))
    return F.coalesce(F.nullif(F.regexp_replace(bare, r"^\.+", ""), F.lit("")), F.lit("capture"))
