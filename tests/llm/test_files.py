"""Tokens, packing, archives, HTML, fingerprints and the classifier."""

import io
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import htmltext, orderminhash, packing, quality, store, tokenfiles, tokens, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = "Some words, and more words. " * 9_000
ODD = ["", None, " ", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "\n", "x\ty z", "it's we'll, 3.14. 5,000.", "<|endoftext|> hi", "É. é, ß.", "İ, ΟΔΟΣ. DŽ.", "a b c ", "a\x1cb \x1c", "中文, 字.", "Ered*** it&&& HE!! THE!!", "a | b|c"]


def docs(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t, "x", 7, 1) for i, t in enumerate(texts)], "doc_id long, text string, part string, length int, start int")


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize(("chunk", "keep"), [(400_000, 1_000), (40, 3)])
def test_pieces_give_the_ids_of_the_whole(name, spaced, chunk, keep, monkeypatch):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices("ab .,\n'A1é\t*!", k=rng.randint(1, 80))) for _ in range(1_500)]
    e = tokens.Encoder(tokens.vocabulary(name), spaced, keep)
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    want = [np.array(x.ids, "<u4").tobytes() for x in e.model.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(e.encode(texts)) == want
    assert list(e.encode(texts)) == want


def test_other_vocabularies_and_long_texts_are_encoded_whole(tmp_path):
    import json

    with open(tokens.vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        other = json.load(f)
    assert not tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), True).whole and not tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False).whole
    other["normalizer"] = {"type": "Replace", "pattern": {"String": "a b"}, "content": "Q"}  # pieces that are cut at spaces would miss this
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other), encoding="utf-8")
    e = tokens.Encoder(str(path), True)
    assert e.whole and list(e.encode(["x a b c", None])) == [np.array(e.model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("x a b c", "")]
    long = "Some words, and more words. " * 120_000
    e = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False)
    assert len(long) > tokens.CHUNK and list(e.encode(["a", long, "b"]))[1] == np.array(e.model.encode(long, add_special_tokens=False).ids, "<u4").tobytes()


def test_token_files_round_trip(spark):
    texts = [*ODD, LONG, "same", "same"]
    df = docs(spark, texts).unionByName(docs(spark, ["null id"]).withColumn("doc_id", F.lit(None).cast("long"))).repartition(5)
    uri, manifest = tokenfiles.write(df, frame=4096)
    got = tokenfiles.read(uri, manifest).toPandas().sort_values("start")
    e = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), True)
    start = 0
    for (doc_id, text), r in zip([(None, "null id"), *enumerate(texts)], got.itertuples()):
        ids = np.array(e.model.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())) and (r.doc_id == doc_id or (doc_id is None and r.doc_id != r.doc_id))
        start += len(ids)
    files = store.Files(uri)
    for row in manifest.collect():  # any zstandard tool reads the file, and one document needs its own frame only
        raw = files.read(row["file"]).read()
        assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read(5_000_000)[:4]
        reader = tokenfiles.Reader(Source(raw))
        whole = list(reader)
        for doc_id, ids in whole:
            if doc_id is not None:
                assert ids in [x.tobytes() for x in reader.find(doc_id)]
        broken = bytearray(raw)
        broken[int(reader.starts[0]) + int(reader.packed[0]) - 3] ^= 255
        with pytest.raises((tokenfiles.Corrupt, zstandard.ZstdError)):
            list(tokenfiles.Reader(Source(bytes(broken))))


def test_empty_tables(spark):
    none = docs(spark, [])
    assert tokenfiles.read(*tokenfiles.write(none)).count() == packing.pack(none).count() == orderminhash.fingerprint(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(pages).count() == htmltext.main_text(pages).count() == 0
    assert quality.classify(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def best_fit_decreasing(lengths, capacity):
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def held(plan):
    out = Counter()
    for pattern, times in plan:
        assert times > 0
        for k, n in pattern:
            out[k] += n * times
    return out


def sequences(plan):
    return sum(times for _, times in plan)


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece_and_are_as_good_as_best_fit(seed):
    rng = random.Random(seed)
    lengths = [min(100, 1 + int(rng.expovariate(1 / rng.choice([8, 30, 60])))) for _ in range(900)]
    counts = Counter(lengths)
    plan = packing.plan(dict(counts), 100)
    assert held(plan) == counts and all(sum(k * n for k, n in pattern) <= 100 for pattern, _ in plan)
    assert sequences(plan) <= min(best_fit_decreasing(lengths, 100), sequences(packing.best_fit(dict(counts), 100)))
    assert packing.plan({}, 100) == []


@pytest.mark.parametrize("counts", [{1366: 3000, 1365: 3000, 2731: 3000}, {2049: 1000, 1366: 1000, 682: 1000, 1365: 1000, 683: 1000, 2047: 500}, {4096: 5}, {4096: 2, 1: 1}])
def test_plans_are_near_the_bound(counts):
    plan = packing.plan(dict(counts))
    some = {k: n for k, n in counts.items() if k < 4096}
    bound = max(packing.solve(some, slack=s)[1] for s in packing.SLACKS) if some else 0.0
    assert held(plan) == Counter(counts) and bound <= sequences(plan) - counts.get(4096, 0) <= 1.03 * bound + 1
    assert sequences(plan) <= sequences(packing.best_fit(dict(counts)))


def fewest(pieces, capacity):
    """The optimum by trying every way, for a few pieces."""
    best = [len(pieces)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= pieces[i]:
                left = list(rooms)
                left.remove(r)
                go(i + 1, [*left, r - pieces[i]])
        go(i + 1, [*rooms, capacity - pieces[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_small_plans_are_optimal_or_one_more(seed):
    rng = random.Random(seed)
    pieces = sorted((rng.randint(3, 22) for _ in range(11)), reverse=True)
    plan, best = packing.plan(dict(Counter(pieces)), 30), fewest(pieces, 30)
    assert held(plan) == Counter(pieces) and best <= sequences(plan) <= best + (seed % 4 == 0) and packing.solve(dict(Counter(pieces)), 30)[1] <= best + 1e-6


def test_knapsack_prices():
    rng = np.random.default_rng(1)
    lengths, prices = np.array([3, 5, 7, 11]), rng.random(4)
    dense = np.full(31, -np.inf)
    dense[lengths] = prices
    sack = packing.Knapsack(dense, 30)
    best = max(a * prices[0] + b * prices[1] + c * prices[2] + d * prices[3] for a in range(11) for b in range(7) for c in range(5) for d in range(3) if 3 * a + 5 * b + 7 * c + 11 * d <= 30)
    inside = sack.contents(30, np.zeros(31), 0.0)
    assert abs(sack.best[30] - best) < 1e-9 and sum(k * n for k, n in inside.items()) <= 30 and abs(sum(dense[k] * n for k, n in inside.items()) - best) < 1e-9


def test_packing(spark):
    texts = [*ODD, LONG, *["three little words"] * 300, "one", None]
    rows = packing.pack(docs(spark, texts).unionByName(docs(spark, ["x"]).withColumn("doc_id", F.lit(None).cast("long"))).repartition(4), capacity=64, rounds=20).collect()
    e = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False)
    by: dict = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {None, *range(len(texts))}
    for i, t in enumerate(texts):
        ids = np.array(e.model.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(by[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 64)) and all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own) and sum(r["length"] for r in own) == len(ids)
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 64 and len(sequences) <= -(-sum(r["length"] for r in rows) // 64) + 2


def test_archives(spark):
    big, twin, small = "<p>" + "é" * 300_000, "x" * 100, "y" * 99
    rows = [(5, "u\r\nv", twin), (2, "b", twin), (9, None, twin), (2, "b2", twin), (1, "c", small), (3, "d", small), (4, "e", None), (6, "f", ""), (7, "g", big), (8, "h", "\r\n\r\nWARC/1.1\r\n"), (None, "i", twin), (None, "j", "alone " * 30)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, n int").repartition(3)
    whole = warc.write(df)
    new = warc.normalise(whole)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read(new).collect())
    want = [(0, "response", None, 180), (0, "revisit", 2, 100), (1, "response", None, 99), (2, "response", None, 100), (2, "response", None, 100), (3, "response", None, 99), (4, "response", None, 0), (5, "revisit", 2, 100), (6, "response", None, 0), (7, "response", None, 600_003), (8, "response", None, 14), (9, "revisit", 2, 100)]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in new.collect():
        files = store.Files(r["folder"])
        raw = files.read(r["file"]).read()
        import json

        entries = [json.loads(x) for x in files.read(r["file"] + ".idx").read().splitlines()]
        assert len(entries) == r["records"] and sum(e["size"] for e in entries) == len(raw)
        for e in entries:
            fields, _ = warc.fetch(r["folder"], r["file"], e)
            assert fields["warc-record-id"] == e["id"]
    assert sum(r["records"] for r in whole.collect()) == len(rows)


def test_broken_archives_are_errors():
    raw = warc.record("response", {"WARC-Record-ID": "x"}, b"block")
    assert [warc.parse(r) for r in warc.records(iter([raw[:7], raw[7:] + raw]))] == [({"warc-type": "response", "warc-record-id": "x", "content-length": "5"}, b"block")] * 2
    with pytest.raises(warc.Malformed):
        list(warc.records(iter([raw, raw[:-3]])))
    assert b"".join(warc.inflate(io.BytesIO(warc.member(raw) + warc.member(raw)))) == raw * 2


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if(a<b)"</p>"</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies, lots of them, really, so accept.</div><div class="ad">Buy, buy, buy now, it is cheap.</div>{}<aside>Side, bar, text that goes on.</aside>
<form><p>Your name, please, and your mail.</p></form><div id="comments"><article class="comment"><p>Great post, really, thanks, a lot, for all of this.</p></article></div><footer>Foot, 2020</footer></body></html>"""


@pytest.mark.parametrize(
    ("main", "want"),
    [
        ("<article><h1>Head &amp; line</h1><p>One,\n two &lt;b&gt;.<p><b>Three</b>fold&nbsp;text.</article>", "Head & line One, two <b>. Threefold text."),
        ("<div id=content><h2>Title</h2><p>A first paragraph, with commas, and enough text to count.</p><p>Second, of the same kind, with <a href=x>a link</a> in it.</p><ul><li>one<li>two</ul></div>", "Title A first paragraph, with commas, and enough text to count. Second, of the same kind, with a link in it. one two"),
        ("<article><p><b>Bold.<br><p>Next.</p><p>Last &copy</article>", "Bold. Next. Last ©"),
        ("<main><section><p>Part one, quite long, with several commas, in it.</p></section><section><p>Part two.</p></section></main>", "Part one, quite long, with several commas, in it. Part two."),
        ("<article>Ti.</article>", "Ti."),
    ],
)
def test_main_text(main, want):
    assert htmltext.extract(PAGE.format(main)) == want


def test_pages_that_are_odd(spark):
    rows = [(1, "u", None), (2, "u", ""), (2, "u", "plain & <3 text"), (None, None, "<p>x</p>"), (4, "u", "<div>" * 5_000 + "deep, text"), (5, "u", "<p a='\"><p>open"), (6, "u", "<!-- never closed <p>x"), (7, "u", "<article>" + "<p>word, word</p>" * 20_000)]
    got = [(r["page_id"], r["text"]) for r in htmltext.main_text(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()]
    assert dict(got[2:5] + got[7:]) == {2: "plain & <3 text", None: "x", 4: "deep, text", 7: " ".join(["word, word"] * 20_000)} and got[0] == (1, "") and got[1] == (2, "") and len(got) == 8


def order_minhash(text):
    """The components of a text's fingerprint, one step at a time."""
    o, data = orderminhash, text.encode()
    anchor = [b % o.EVERY == o.AT for b in data]
    places = [i for i in range(len(data)) if anchor[i] or (i >= o.GAP and not any(anchor[i - o.GAP : i]))]
    if 0 < len(data) <= o.GAP and not any(anchor):
        places = [0]
    number = lambda x, seed: xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
    seen, parts = Counter(), {}
    for nth, i in enumerate(places, 1):
        h = xxhash.xxh64_intdigest(data[i : i + o.K].decode("latin-1").encode(), 42) % 2**33
        again = seen[h]
        seen[h] += 1
        if again:
            h = xxhash.xxh64_intdigest((again - 1).to_bytes(4, "little"), number(h, 42)) % 2**33
        parts.setdefault(h >> 27, []).append((h, nth))
    out = []
    for part, elements in parts.items():
        least = sorted(elements)[: o.TUPLE]
        seed = 42
        for h, _ in sorted(least, key=lambda e: e[1]):
            seed = number(h, seed)
        out.append(part << 58 | seed >> 6)
    return sorted(out, key=lambda c: (c < 2**63, c))


def alike(a, b):
    parts = {c >> 58 for c in a} | {c >> 58 for c in b}
    return len(set(a) & set(b)) / len(parts) if parts else 1.0


def test_order_minhash(spark):
    import hashlib

    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 400))) for _ in range(20)] + ["", None, "one", "the same text again", "the same text again", LONG, "nospace" * 500, "a a a a b a a a", "zz" * 300, "\u4e2d\u6587\u5b57" * 40, "\U0001f600 x" * 30, "z"]
    got = {r["doc_id"]: r for r in orderminhash.fingerprint(docs(spark, texts, 10).repartition(3), run=900).collect()}
    own = [t or "" for t in texts]
    read = lambda x: [int(c, 16) for c in x.split(",") if c]
    for i, t in enumerate(own):
        n = len(t) // 2
        after = own[(i + 1) % len(own)]
        edited = t[: len(t) - n] + after[:n]
        r = got[10 + i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert read(r["fingerprint"]) == order_minhash(t) and read(r["edited_fingerprint"]) == order_minhash(edited)
        assert abs(r["near_edited"] - alike(order_minhash(t), order_minhash(edited))) < 1e-12 and abs(r["near_next"] - alike(order_minhash(t), order_minhash(after))) < 1e-12
    assert got[33]["fingerprint"] == got[34]["fingerprint"] and got[33]["near_next"] == 1.0 and got[30]["near_next"] == 1.0
    assert np.mean([got[10 + i]["near_edited"] for i in range(20)]) > 0.08 and np.mean([got[10 + i]["near_next"] for i in range(19)]) < 0.02


def test_every_byte_begins_a_kmer(spark, monkeypatch):
    """No place of a text is left out, and what is looked at first changes no fingerprint."""
    rng = random.Random(8)
    texts = ["", "a", "plain text of some length", "\u00e9t\u00e9 \u4e2d\u6587 x", "".join(rng.choices("abcd \u00e9", k=900)), "again and again " * 60, " ".join(f"w{rng.randrange(400)}" for _ in range(900))]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", orderminhash.kmers(F.col("text")).alias("p"))
    for r in df.collect():
        data = r["text"].encode()
        assert [(x & (1 << 31) - 1, x >> 31 & 2**33 - 1) for x in r["p"]] == [(i + 1, xxhash.xxh64_intdigest(data[i : i + 12].decode("latin-1").encode(), 42) % 2**33) for i in range(len(data))]
    seen = []
    for first in (10**6, 24, 4, 1):
        monkeypatch.setattr(orderminhash, "FIRST", first)
        seen.append(sorted((r["text"], tuple(r["c"])) for r in orderminhash.components(df, {"c": "p"}).collect()))
    assert all(x == seen[0] for x in seen) and len(seen[0]) == len(texts)


@pytest.mark.parametrize("text", ["plain text, again and again and again", "\u00e9t\u00e9 \u4e2d\u6587 and more, and more", "short", "z"])
def test_kmers_from_a_place_on(spark, text):
    """The edited text's k-mers begin as the text's own, so the rest can be taken alone; arrays to be sorted can't have nulls."""
    df = spark.createDataFrame([(text, n) for n in range(len(text.encode()))], "text string, n int").withColumn("n", F.coalesce("n", F.lit(0)))
    both = df.select("n", orderminhash.kmers(F.col("text")).alias("p"), orderminhash.kmers(F.col("text"), F.col("n")).alias("q")).withColumn("c_r", orderminhash._repeated("p"))
    assert all(r["q"] == r["p"][r["n"] :] for r in both.collect())
    assert not any(both.withColumn("m", orderminhash._numbered("c_r")).schema[c].dataType.containsNull for c in ("p", "q", "c_r", "m"))


def test_an_inserted_character_is_a_small_edit(spark):
    rng = random.Random(6)
    for text in ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=2_000)), "".join(rng.choices("bdfz", k=2_000)), "".join(chr(0x4E00 + rng.randrange(3_000)) for _ in range(1_000))):
        for at in (0, 700):
            assert orderminhash.fingerprint(docs(spark, [text, text[:at] + "q" + text[at:]])).orderBy("doc_id").first()["near_next"] > 0.8


def test_equal_and_null_ids_are_in_order_of_their_hash(spark):
    df = spark.createDataFrame([(None, f"null {i} " * 40) for i in range(40)] + [(5, f"five {i} " * 40) for i in range(60)] + [(i, f"own {i} " * 40) for i in range(6, 20)], "doc_id long, text string")
    whole, cut = (sorted(map(tuple, orderminhash.fingerprint(df, run=n).collect()), key=str) for n in (10**9, 2_000))
    assert whole == cut and len(cut) == 114 and orderminhash.ranged(df, 2_000)[1] > 10
    hot = orderminhash.ranged(df, 2_000)[0].where("doc_id = 5").select("run").distinct().count()
    assert hot > 2


def test_order_matters_to_fingerprints(spark):
    blocks = [" ".join(f"b{k}x{i}" for i in range(40)) for k in range(12)]
    mixed = blocks[::-1]
    a, b, c = (r["fingerprint"].split(",") for r in orderminhash.fingerprint(docs(spark, [" ".join(blocks), " ".join(mixed), " ".join(blocks[:-1])])).orderBy("doc_id").collect())
    same = lambda x, y: len(set(x) & set(y)) / orderminhash.SIZE
    # A tuple survives the loss of a twelfth of the text with (11 / 12) ** 2, the reversed order only if its elements are in one block.
    assert same(a, c) > 0.7 and same(a, b) < 0.3


@pytest.mark.parametrize("n", [0, 1, 2, 7, 50])
def test_ranks(spark, n):
    bounds = sorted({k * k % 97 for k in range(n)} | ({9} if n else set())) + ([96] * 3 if n else [])
    df = spark.range(-1, 99).select("id", orderminhash._below(F.col("id"), bounds, True).alias("a"), orderminhash._below(F.col("id"), bounds, False).alias("b")).orderBy("id")
    assert [(r["a"], r["b"]) for r in df.collect()] == [(sum(b < x for b in bounds), sum(b <= x for b in bounds)) for x in range(-1, 99)]


def test_order_minhash_runs_no_python(spark):
    plan = orderminhash.fingerprint(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "ArrowEval"))


ARTICLE = "<article><h1>Title</h1><p>" + "Some long text, with commas, and more of it. " * 8 + "</p><p>Second one, also, here it is with words enough.</p><p>Sources:</p><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></article>"
WORDS_OF_PAGES = ["content no-sidebar", "has-sidebar", "ad-free", "page-with-comments", "search-results", "form-page", "social-science", "hidden-gems", "without_banner", "related"]


@pytest.mark.parametrize("name", WORDS_OF_PAGES)
@pytest.mark.parametrize("where", ['<div class="{}">{}</div>', '<div id="{}"><div>{}</div></div>', '<body class="{}">{}', '<div class="{}"><form action=x>{}<input></form></div>'])
def test_an_article_is_never_lost_to_a_word(name, where):
    page = "<nav>menu</nav>" + where.format(name, ARTICLE) + '<div class="comments"><p>Nice text, really, good, thanks a lot for all of it.</p></div><div class="ad">Buy, now, this</div><footer>foot</footer>'
    text = htmltext.extract(page)
    assert text.startswith("Title Some long text") and text.endswith("Sources: One Two") and "Nice" not in text and "Buy" not in text


SUBJECTS = ["ads-and-marketing", "comment-section-wrapper", "sponsor-story", "footer-layout-grid", "newsletter", "subscribe", "post menu-food", "nav-lit story", "rss-item", "skip-link-target"]


@pytest.mark.parametrize("name", SUBJECTS)
@pytest.mark.parametrize("head", ["", "<h1>A title of this page, and a long one</h1>"])
def test_the_only_content_stays_whatever_it_is_called(name, head):
    p = "<p>This is the first paragraph, long enough to count.</p><p>And a second one that goes on, and on, for a while.</p>"
    text = htmltext.extract(f"<body><nav><a href=x>Home</a></nav>{head}<div class='{name}'>{p}</div><footer>Imprint</footer></body>")
    assert text.endswith("This is the first paragraph, long enough to count. And a second one that goes on, and on, for a while.")


@pytest.mark.parametrize("part", ['<h2 class="menu-title">{}</h2>', '<p class="cookie-recipe">{}</p>', '<p class="code-comment">{}</p>', '<p class="promotion-chess">{}</p>', '<div class="alert">{}</div>'])
def test_parts_of_an_article_stay(part):
    said = "Mind that this is a part of it."
    text = htmltext.extract(f"<body><article><p>This is the first paragraph, long enough to count.</p>{part.format(said)}<p>The end.</p></article></body>")
    assert text == f"This is the first paragraph, long enough to count. {said} The end."


def test_split_articles_keep_short_parts():
    one = "<div><p>This is a paragraph, long enough to count, of a split article.</p><p>And another one, of some length.</p></div>"
    assert htmltext.extract(f"<body>{one}{one}<div>Short end.</div><div class='ad'>Buy it</div></body>").endswith("of some length. Short end.")


def test_a_marked_part_never_replaces_an_article():
    assert htmltext.extract('<body><div class="ad">Words of an advert, that go on for quite a while.</div><article><h1>Tiny.</h1><p>So.</article></body>') == "Tiny. So."


def test_marked_parts_go():
    comments = "<article><p>I disagree, really, I do, strongly, so much that I write a long text, ok.</p></article>" * 30
    assert htmltext.extract(f"<body>{ARTICLE}<div id=comments>{comments}</div></body>").endswith("Two")
    assert htmltext.extract('<body><div class="ad">Buy this thing now, or else.</div><article></article></body>') == ""
    assert htmltext.extract("<body><div class='related-posts'><p>Other, post</p></div>" + ARTICLE + "</body>").startswith("Title")


def test_uris_come_back_as_they_were(spark):
    urls = ["http://x/a%20b?q=%25&r=1", None, "http://x/\u00e9 b", "", "http://x/c%", "a: b"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, n int")
    assert {r["page_id"]: r["url"] for r in warc.archive(pages).collect()} == dict(enumerate(urls))


def test_archives_agree_with_sql(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(9)
    bodies = [None, "", "short", *("x" * rng.randint(90, 110) + str(i % 7) for i in range(30))]
    rows = pd.DataFrame([(i, f"http://x/{i}", rng.choice(bodies)) for i in rng.sample(range(900), 300)], columns=["page_id", "url", "html"])
    pages = rows  # noqa: F841
    want = duckdb.sql("""WITH p AS (SELECT *, encode(coalesce(html, '')) AS b FROM pages), f AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d, min(page_id) OVER (PARTITION BY b) AS first FROM p)
SELECT page_id, n, d, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END, CASE WHEN n >= 100 AND page_id <> first THEN first END FROM f""").fetchall()
    got = warc.archive(spark.createDataFrame(rows).repartition(3)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(r[4] is not None for r in want)


def corpus(n, rng):
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("ana", "ero", "ist", "un")]
    out = []
    for i in range(n):
        text = ". ".join(" ".join(rng.choices(words, k=9)).capitalize() for _ in range(rng.randint(1, 12)))
        bad = i % 4 == 0
        out.append((i, text.replace(" ", "*** ") if bad and i % 8 else text.upper().replace(" ", "!! ") if bad else text, 0 if bad else 1))
    return out


def test_classifier_learns_and_never_sees_held_out_labels(spark):
    rows = corpus(900, random.Random(5))
    df = docs(spark, [t for _, t, _ in rows] + [None, "", LONG])
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(3, None, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(df, labels).collect()}
    held = {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in got.items() if r["held_out"]} == held and len(got) == 903
    assert np.mean([got[i]["predicted"] == q for i, _, q in rows if i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.classify(df, flipped).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    assert {r["doc_id"] for r in quality.keep(df, labels).collect()} == {i for i, r in got.items() if r["predicted"]}
    one = quality.classify(df, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0][0] > 0.9


def test_pairs_are_learned():
    rng = np.random.default_rng(2)
    x = rng.random((3_000, 20))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    m = quality.fit(x[:2_000], y[:2_000])
    assert ((m.score(x[2_000:]) > 0.5) == y[2_000:]).mean() > 0.9 and {0, 1} in [{f, g} for f, g, *_ in m.pairs]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_pipeline(spark):
    import corpus_pipeline

    read = spark.read.parquet(f"{SF}/documents.parquet")
    docs_, kept = read, []
    for name, stage in corpus_pipeline.STAGES:
        out = store.table(stage(spark, docs_, SF), name)
        if name != "best_fit_packing":
            assert out.columns == read.columns
            kept.append({r["doc_id"] for r in out.select("doc_id").collect()})
            assert kept[-1] <= ({r["doc_id"] for r in docs_.select("doc_id").collect()})
        docs_ = out
    placed = {r["doc_id"] for r in docs_.collect()}
    assert placed == kept[-1] and len(placed) > 100 and len(kept[0]) < read.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, docs_.select("doc_id", "piece", "ids_crc32").collect()))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_frequent_pieces_stay_when_others_go(name):
    """A full store drops what isn't asked for, so that frequent pieces aren't encoded again."""
    encoder = tokens.Encoder(tokens.vocabulary(name), name.startswith("byte"), keep=20)
    often, asked = "some words that every text has", []
    for i in range(5):
        words, plain = encoder._words, encoder._encode
        encoder._words = lambda w, lead: asked.append(set(w)) or words(w, lead)
        text = f"x {often} " + " ".join(f"rare{i}x{k}" for k in range(30))
        assert list(encoder.encode([text])) == plain([text])
        encoder._words = words
        assert len(encoder.rest) <= 40
    assert set(often.split()) <= set().union(*asked) and sum("words" in w for w in asked) == 1
