"""Addresses and canonical JSON: what built-in functions don't have, as vectorised UDFs."""

from __future__ import annotations

import ipaddress
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _compress(x: str | None) -> str | None:
    try:
        return ipaddress.ip_address(x).compressed if x else x
    except ValueError:
        return x


def ip6(name: str) -> Column:
    @F.pandas_udf(T.StringType())
    def compress(s: pd.Series) -> pd.Series:
        return s.map(_compress)

    return compress(F.col(name))


def compressed(name: str) -> Column:
    """The canonical text of an address; what isn't one passes unchanged. Only texts with a colon leave the JVM's fast path."""
    return F.when(F.contains(F.col(name), F.lit(":")), ip6(name)).otherwise(F.col(name))


def packed(ip: Column) -> Column:
    """An address as the hexadecimal text of its bytes: 8 digits for IPv4, 32 for IPv6; texts order as the bytes do."""
    pair = lambda a, b: F.lpad(F.hex(a.cast("bigint") * 256 + b.cast("bigint")), 4, "0")
    dotted = F.split(F.regexp_extract(ip, r"([0-9.]+)$", 1), r"\.")
    tail = F.concat(pair(F.get(dotted, 0), F.get(dotted, 1)), pair(F.get(dotted, 2), F.get(dotted, 3)))
    # An IPv4 address at the end of an IPv6 one is its last two groups.
    plain = F.when(F.contains(ip, F.lit(".")), F.concat(F.regexp_replace(ip, r"[0-9.]+$", ""), F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))).otherwise(ip)
    digits = lambda x: F.array_join(F.transform(F.filter(F.split(x, ":"), lambda g: g != ""), lambda g: F.lpad(F.lower(g), 4, "0")), "")
    head, rest = F.split_part(plain, F.lit("::"), F.lit(1)), F.split_part(plain, F.lit("::"), F.lit(2))
    zeros = F.repeat(F.lit("0"), 32 - F.length(digits(head)) - F.length(digits(rest)))
    return F.when(F.contains(ip, F.lit(":")), F.concat(digits(head), zeros, digits(rest))).otherwise(F.lower(tail))


def canonical_json(name: str, *dropped: str) -> Column:
    """JSON with sorted keys and without the ``dropped`` paths (``a`` or ``a.b``); what isn't JSON is an error."""

    @F.pandas_udf(T.StringType())
    def dump(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _canonical(x, dropped))

    return dump(F.col(name))


def _canonical(text: str | None, dropped: tuple[str, ...]) -> str | None:
    if text is None:
        return None
    value = json.loads(text)
    for path in dropped:
        *way, last = path.split(".")
        at = value
        for k in way:
            at = at.get(k) if isinstance(at, dict) else None
        if isinstance(at, dict):
            at.pop(last, None)
    return json.dumps(value, sort_keys=True, ensure_ascii=False)
