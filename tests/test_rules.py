import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rules

HEAD = "alert tcp $HOME_NET any -> any any "


def values(spark, texts, expr):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r["x"] for r in rows.select("i", expr(F.col("text")).alias("x")).orderBy("i").collect()]


def test_states(spark):
    texts = [HEAD + "(sid:1;)", "#alert x", "## alert x", "# a comment", "", "  alert tcp", "alerting"]
    assert values(spark, texts, rules.state) == ["active", "disabled", "disabled", "other", "other", "active", "other"]


def test_sids(spark):
    texts = [HEAD + '(msg:"sid:7;"; sid:8; rev:1;)', HEAD + "(sid : 9;)", HEAD + "()", HEAD + "(sid:1; sid:2;)"]
    assert values(spark, texts, rules.sid) == [7, 9, None, 1]
    assert values(spark, texts, rules.last_sid) == [8, 9, None, 2]


def test_metadata_last_wins_and_verdicts_in_order(spark):
    m = lambda x: f"{HEAD}(metadata:{x}; sid:1;)"
    texts = [m("confidence High, signature_severity Major"), m("confidence High; metadata: Confidence Low"), m("confidence high"), m("signature_severity Major"), m("confidence HIGH, signature_severity critical"), HEAD + "(sid:1;)"]
    assert values(spark, texts, lambda t: rules.metadata(t, "confidence")) == ["High", "Low", "high", None, "HIGH", None]
    assert values(spark, texts, rules.metadata_verdict) == [None, "low_confidence", "low_severity", "no_confidence", None, "no_confidence"]


@pytest.mark.parametrize(
    ("message", "want"),
    [("🐾 - 👁 seen", "👁"), ("🐾 -🚨 x", "🚨"), ("👁 - no brand", "👁"), ("🐾 - plain", None), ("plain 👁", None), ("🐾 - Élévation", None), ("🔥👁 both", "🔥"), ("🏴‍☠️ flag", "🏴"), ("ℹ info", "ℹ"), ("🐾 — 🌐 dash", "🌐"), ("", None)],
)
def test_markers_are_positional(spark, message, want):
    assert values(spark, [f'{HEAD}(msg:"{message}"; sid:1;)'], rules.marker) == [want]


def test_negated_home_net(spark):
    head = lambda x: f"alert udp $HOME_NET any -> {x} any (msg:\"!$HOME_NET\"; sid:1;)"
    texts = [head(x) for x in ("any", "!$HOME_NET", "![10.0.0.0/8,$HOME_NET]", "![10.0.0.0/8,[192.168.0.0/16,$HOME_NET]]", "!$HOME_NETWORKS", "![10.0.0.0/8]", "[!10.0.0.1,$HOME_NET]", "![10.0.0.0/8,$HOME_NET")]
    assert values(spark, texts, rules.negates_home_net) == [False, True, True, True, False, False, False, True]


def _options(rule):
    """A state machine over one rule's body: the oracle of the regular expression."""
    body, out, now, quoted, i = rule[rule.index("(") + 1 : rule.rindex(")")], [], "", False, 0
    while i < len(body):
        c = body[i]
        if c == "\\" and i + 1 < len(body):
            now, i = now + body[i : i + 2], i + 2
            continue
        if c == '"':
            quoted = not quoted
        if c == ";" and not quoted:
            out.append(now.strip())
            now = ""
        else:
            now += c
        i += 1
    return [o for o in [*out, now.strip()] if o]


def test_options_agree_with_a_state_machine(spark):
    rng = random.Random(2)
    parts = ['content:"a;b"', "sid:1", 'msg:"x\\"y"', r"pcre:/a\;b/", "nocase", 'content:"\\\\"', "flow:to_server, established"]
    texts = [HEAD + "(" + "; ".join(rng.choices(parts, k=rng.randint(1, 5))) + ";)" for _ in range(60)]
    assert values(spark, texts, rules.options) == [_options(t) for t in texts]
    assert values(spark, [HEAD + '(msg:"open; sid:1;)', "no body"], rules.options) == [None, None]


def test_address_indicators(spark):
    body = lambda x: f"{HEAD}({x})"
    texts = [body("msg:\"x\"; sid:1; rev:2;"), body('content:"x"; sid:1;'), body("flowbits:set,a; sid:1;"), body("flowbits:isset,a; sid:1;"), body("dcerpc.iface:1; sid:2;"), body('msg:"open; sid:1;'), body("")]
    assert values(spark, texts, rules.address_indicator) == [True, False, True, False, False, False, False]


def _joined(lines):
    out, parts = [], None
    for t in lines:
        if parts is None and t.lstrip().startswith("#"):
            out.append(t)
        elif t.rstrip().endswith("\\"):
            parts = (parts or "") + t.rstrip()[:-1]
        else:
            out.append((parts or "") + t)
            parts = None
    return out + ([parts] if parts is not None else [])


def test_continuations_agree_with_a_loop(spark):
    rng = random.Random(4)
    kinds = ["a;", "b \\", "# c", "# banner \\", "d\\", "", "e"]
    all_ = {f"s{k}": rng.choices(kinds, k=rng.randint(1, 12)) for k in range(60)}
    df = spark.createDataFrame([(s, i, t) for s, ls in all_.items() for i, t in enumerate(ls)], "source string, line_no long, text string")
    got: dict = {}
    for r in rules.logical_lines(df).orderBy("source", "line_no").collect():
        got.setdefault(r["source"], []).append(r["text"])
    assert got == {s: _joined(ls) for s, ls in all_.items()}


def test_one_source_is_joined_by_many_tasks(spark):
    """Blocks of line numbers cut runs anywhere; a source's lines aren't one task's."""
    rng = random.Random(5)
    lines = rng.choices(["# note \\", "# note", "alert a; \\", "b; \\", "c", ""], k=400)
    df = spark.createDataFrame([("s", 3 * i, t) for i, t in enumerate(lines)] + [(None, None, "alone \\"), (None, 7, "end")], "source string, line_no long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for block in (1, 7, 50, 10**6):
            got = rules.logical_lines(df, block).withColumn("task", F.spark_partition_id()).orderBy("source", "line_no").collect()
            assert [r["text"] for r in got if r["source"]] == _joined(lines) and [(r["line_no"], r["text"]) for r in got if not r["source"]] == [(None, "alone end")]
            assert len({r["task"] for r in got if r["source"]}) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_admission_is_a_partition(spark):
    ok = "metadata:confidence High, signature_severity Major; "
    texts = [f"{HEAD}({ok}sid:1;)", f"{HEAD}(sid:2;)", f"{HEAD}({ok}classtype:policy-violation; sid:3;)", f"alert tcp any any -> !$HOME_NET any ({ok}sid:4;)", f'{HEAD}(msg:"👁 x"; {ok}sid:5;)', f"#{HEAD}(sid:6;)", "# words", f"{HEAD}({ok}ja3.hash; sid:7;)"]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "source string, line_no long, text string")
    r = rules.admission(rules.judge(df)).first()
    assert (r["fetched"], r["admitted"], r["commented"], r["ja3_admitted"]) == (7 - 1, 2, 1, 1)
    assert r["fetched"] == r["admitted"] + sum(r[v] for v in rules.COUNTED) and (r["no_confidence"], r["classtype"], r["unloadable"], r["marker"]) == (1, 1, 1, 1)
    assert rules.admission(rules.judge(df, filtered=False)).first()["admitted"] == 3


def test_content_address_is_framed_and_ordered(spark):
    files = {"b": b"x\0y", "a": b"", "c/d": bytes(range(256)) * 3}
    rows = [(k, bytearray(v)) for k, v in files.items()]
    want = rules.content_id_of(files)
    assert rules.content_id(spark.createDataFrame(rows, "path string, content binary")).first()[0] == want
    assert rules.content_id(spark.createDataFrame(rows[::-1], "path string, content binary")).first()[0] == want
    assert rules.content_id_of({"a": b"bc"}) != rules.content_id_of({"ab": b"c"})
