"""Conversation repair, language identification and periodic runs against brute force."""

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations, langid, periodic

# Periodic runs


def every_run(x, least, times):
    """Runs by trying every period at every place."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= least and n >= times * q), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_squares_give_every_run(seed):
    rng = random.Random(seed)
    for _ in range(150):
        letters = rng.choice([1, 2, 2, 3, 4])
        x = [rng.randrange(letters) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.4:
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 8))]
            x = x[: len(x) // 3] + (unit * 20)[: rng.randint(5, 40)] + x[len(x) // 3 :]
        assert periodic.Sequence(np.array([*x, 99])).runs(1, 2) == every_run(x, 1, 2)


def test_the_filter_and_pooled_documents_lose_nothing():
    rng = random.Random(4)
    for _ in range(60):
        docs = []
        for _ in range(rng.randint(1, 6)):
            x = [b"%d" % rng.randrange(rng.choice([2, 50, 1000])) for _ in range(rng.randint(0, 200))]
            if x and rng.random() < 0.7:
                x += (x[-rng.randint(1, 40) :] * 10)[: rng.randint(0, 200)] + [b"%d" % rng.randrange(5) for _ in range(rng.randint(0, 30))]
            docs.append(x)
        assert periodic.find(docs) == [every_run(x, periodic.LEAST, periodic.TIMES) for x in docs]


@pytest.mark.parametrize(("n", "p"), [(60_000, 1), (60_000, 7), (60_000, 20_000)])
def test_long_runs_take_linear_time(n, p):
    unit = [b"%d" % k for k in range(p)]
    assert periodic.find([(unit * (n // p + 1))[:n]]) == [[(0, n, p)]]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_collapse(spark):
    loop = "one two three four five. " * 12
    texts = [None, "", " \n", loop, loop, "a " * 23, "a " * 24, "x " + loop + "y z\x1cq", " ".join(str(k) for k in range(40)), "é " * 30, *(f"w{k} and some more words to go on with, {k} of them; " * 4 for k in range(60))]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(None, loop, "x", 1, "y")], "doc_id long, text string, runs string, start int, collapsed string").repartition(3)
    for changed in (False, True):
        rows = periodic.collapse(df, loop=changed).collect()
        assert len(rows) == len(texts) + 1
        for r in rows:
            words = WORD.findall((loop if r["doc_id"] is None else texts[r["doc_id"]]) or "")
            n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
            if changed and r["doc_id"] is not None and n and h % 10 == 0:
                a = h // 10 % n
                p = 1 + (n - a) // (3 + h // 10 % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            runs = every_run(words, 24, 3)
            best = max(runs, key=lambda t: (Fraction(t[1], t[2]), -t[0], -t[2]), default=None)
            gone = {i for s, m, q in runs for i in range(s + q, s + m)}
            kept = " ".join(w for i, w in enumerate(words) if i not in gone)
            assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == kept and r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
            assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
    assert periodic.collapse(df.limit(0)).count() == 0


# Conversations


def cheapest(rows):
    """Faults, and the least (cost, letters, what is left) over all ways to edit rows (role, text)."""
    seen, faults = set(), []
    for r, t in rows:
        w = [c for c in t if c not in " \t\n\v\f\r"]
        faults.append("b" if not w else "d" if (r, t) in seen else "t" if w[-1] not in ".!?" else "")
        seen.add((r, t))
    following, name = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, s, made):
        out = [(0, "", ())] if i == len(rows) and s in ("", "a") else []
        u = following[s]
        if made < 3:
            c, a, x = best(i, u, made + 1)
            out.append((c + 5, "I" + a, ((name[u], ""), *x)))
        if i < len(rows):
            (r, t), late = rows[i], 5 * (faults[i] == "t")
            c, a, x = best(i + 1, s, 0)
            out.append((c + 2, "D" + a, x))
            if faults[i] in ("", "t"):
                if r[:1] == u or (r[:1] == "s" and not s):
                    c, a, x = best(i + 1, r[:1], 0)
                    out.append((c + late, "K" + a, ((r, t), *x)))
                c, a, x = best(i + 1, u, 0)
                out.append((c + 1 + late, "R" + a, ((name[u], t), *x)))
        return min(out, key=lambda o: o[:2], default=(10**9, "", ()))

    return faults, best(0, "", 0)


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_edits_whole_and_in_segments(seed):
    rng = random.Random(seed)
    for _ in range(250):
        n = rng.randint(0, 9)
        rows = [(rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]), rng.choice(["hi.", "ok!", "no end", "", " ", "x?", "y.", "z. "])) for _ in range(n)]
        _, (cost, letters, left) = cheapest(rows)
        known = conversations._unseen([(i, r, t) for i, (r, t) in enumerate(rows)])
        piece = conversations.Segment(known).piece()
        assert (piece["cost"], piece["audit"], [(t["role"], t["text"]) for t in piece["repaired"]]) == (cost, letters, list(left))
        cuts = sorted(rng.randint(0, n) for _ in range(3))
        parts = [conversations.Segment(known[i:j]) for i, j in zip([0, *cuts], [*cuts, n])]
        ends = conversations._ends([conversations._between(s) for s in parts])
        entries = conversations._entries([conversations._exits(s, e) for s, e in zip(parts, ends)])
        pieces = [conversations._piece(*x) for x in zip(parts, ends, entries)]
        assert ("".join(p["audit"] for p in pieces), sum(p["cost"] for p in pieces)) == (letters, cost)


def conversation_rows(seed, hot):
    rng = random.Random(seed)
    text = lambda: rng.choice(["Hi.", "Well?", "no end", "", " ", f"Number {rng.randrange(400)}."])
    rows = [(c, rng.choice([t, t, t, t, None if c % 7 == 0 else t]), rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([text(), text(), None])) for c in range(40) for t in range(rng.randint(1, 8))]
    return rows + [(99, t, "user" if t % 2 else "assistant", f"Turn {t % 300}{'.' * (t % 5 > 0)}") for t in range(hot)] + [(None, 1, "user", "A."), (None, 2, "assistant", "B.")]


@pytest.mark.parametrize("hot", [0, 900])
def test_repair_of_a_table(spark, hot):
    rows = conversation_rows(5, hot)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, audit string").repartition(4)
    by, ids = defaultdict(list), {r[0] for r in rows}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            by[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {r["conv_id"]: r for r in conversations.audit(conversations.repair(conversations.damage(df))).collect()}
    assert set(got) == ids
    for c in ids:
        own = sorted(by[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        if len(own) > 200:
            assert len(got[c]["audit"]) >= len(own) and not re.search("[^DIKR]", got[c]["audit"])
            whole = conversations.Segment(conversations._unseen(own)).piece()
            assert (got[c]["cost"], got[c]["audit"]) == (whole["cost"], whole["audit"])
            assert got[c]["repaired_sha256"] == hashlib.sha256(conversations._joined(whole["repaired"])).hexdigest()
            continue
        faults, (cost, letters, left) = cheapest(tuple((r, t) for _, r, t in own))
        turns, first = [r[0] for r in own if r[0] is not None], [r[1][:1] for r in own]
        want = {
            "conv_id": c, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), "cost": cost, "audit": letters, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        }
        assert got[c].asDict() == want
    assert conversations.audit(conversations.repair(conversations.damage(df.limit(0)))).count() == 0


# Languages

WORDS = {"en": "the of and thing which water with would ing this", "de": "der und nicht einen schön für sich über werden das", "fr": "le les était pour être nous avec où ça dans"}


def language_table(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(WORDS[lang].split(), k=rng.choice([3, 20, 300]))), lang) for i in range(600) for lang in [rng.choice(list(WORDS))]]
    odd = [(1000, None, "en"), (1001, "", "de"), (1002, "12 .,! 3", "fr"), (1003, "The Water. " * 20_000, None), (None, "werden über", "de"), (0, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2])]
    return spark.createDataFrame([(*r, "x", 1.5) for r in rows + odd], "doc_id long, text string, lang string, lang_pred string, score double"), rows


def test_languages(spark):
    df, rows = language_table(spark)
    got = langid.identify(df).collect()
    assert len(got) == len(rows) + 7 and len([r for r in got if r["doc_id"] == 0]) == 3
    said = {r["doc_id"]: r for r in got}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {r[0] for r in held} == {i for i, r in said.items() if r["held_out"] and i is not None and i < 600} and not said[None]["held_out"]
    assert sum(said[i]["lang_pred"] == lang for i, _, lang in held) >= 0.98 * len(held)
    assert {said[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"} and {said[i]["score"] for i in (1000, 1001, 1002)} == {0.0}
    assert said[1003]["lang_pred"] == "en" and said[None]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in got)
    assert langid.identify(df.limit(0)).count() == 0
    none = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.select("lang_pred").distinct().collect()} == {"und"}


def test_held_out_rows_and_other_columns_change_nothing(spark):
    df, _ = language_table(spark)
    held = langid.held_out(F.col("doc_id"))
    other = df.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("lang_pred", F.lit("z"))
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["score"])
    assert sorted(langid.identify(df).collect(), key=key) == sorted(langid.identify(other.repartition(5)).collect(), key=key)


def test_grams_and_weights():
    assert langid.grams("12 .") is None and langid.grams(None) is None
    held, counts = langid.grams("Ab, aB")
    assert counts.sum() == 3 * len(" ab ab ") - 3 and (langid.grams("aB!!! ab")[0] == held).all()
    long = langid.grams("word und " * 30_000)
    assert len(long[0]) == len(langid.grams("word und word und")[0])
    model = langid.fit([("en", *langid.grams(WORDS["en"])), ("de", *langid.grams(WORDS["de"]))] * 30, np.ones(langid.BUCKETS))
    assert (model.weights == 0).mean() > 0.99 and model.predict("the thing")[0] == "en" and abs(_sum(model, "the und") - 1) < 1e-9
    assert langid.fit([("en", *langid.grams("the"))], np.ones(langid.BUCKETS)).predict("das") == ("en", 1.0)


def _sum(model, text):
    return langid._softmax(model.logits(langid.grams(text)) / model.temperature).sum()
