"""Near-duplicates, decontamination, licenses and line dedup against brute force."""

import hashlib
import random

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, decontaminate, grams, licenses, linededup, simhash

LONG = "word " * 60_000
DOCS = "doc_id long, text string, source string, fp string, root int, key string"


def docs(spark, texts, sources=None):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, sources[i] if sources else "s", "x", 1, "k") for i, t in enumerate(texts)], DOCS)


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def near_texts(rng):
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(30):
        base = rng.choices(words, k=rng.randint(60, 200))
        for _ in range(rng.choice([1, 1, 2, 5])):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = rng.choice(words)
            out.append(" ".join(other))
    return out


@pytest.mark.parametrize("text", ["", None, " \t\n", "A", "a B\x0bc", "É é Ünï one Two three four five", "x " * 9, "nbsp stays one two three four", LONG])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " ", *near_texts(rng), "same words here and there", "same words here and there", LONG, LONG]
    want_fp = [brute_fingerprint(t) for t in texts]
    want = brute_components(range(len(texts)), lambda a, b: (want_fp[a] ^ want_fp[b]).bit_count() <= 4)
    got = simhash.near_duplicates(docs(spark, texts)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{want_fp[i]:016x}", want[i]) for i in range(len(texts))}


def test_the_pipeline_links_similar_documents_as_brute_force_does(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "too short", "Too  short"]
    for n in (40, 120, 400):
        for _ in range(12):
            base = rng.choices(words, k=n)
            for _ in range(4):
                other = list(base)
                for _ in range(rng.randint(0, max(1, n // 40))):
                    other[rng.randrange(n)] = rng.choice(words)
                texts.append(" ".join(other))
    base = rng.choices(words, k=300)
    texts += [" ".join([*base, *rng.choices(words, k=8)]) for _ in range(60)]  # one large group
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for t in texts]
    alike = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = brute_components(range(len(texts)), alike)
    far = [(a, b) for a in want for b in range(a) if alike(a, b) and (brute_fingerprint(texts[a]) ^ brute_fingerprint(texts[b])).bit_count() > 4]
    assert len(far) > 50
    got = {r["doc_id"]: r["component_id"] for r in simhash.alike(docs(spark, texts)).collect()}
    assert got == want
    assert {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs(spark, texts), "").collect()} == set(want.values())


@pytest.mark.parametrize(("sample", "shard"), [(10, 5), (200, 40), (5_000, 300)])
def test_any_tree_finds_every_link(spark, sample, shard):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 700, dtype=np.uint64)
    near = base[:200].copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    fps = np.unique(np.concatenate([base, near, np.arange(40, dtype=np.uint64)])).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    near_ = {r["node"]: r["root"] for r in components.connected(simhash.links(df, 4, sample, shard)).collect()}
    want = brute_components(sorted(fps), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {x: near_.get(x, x) for x in fps} == want


def test_routes_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(4)
    p = rng.integers(0, 2**63, 3_000, dtype=np.uint64)
    q = p ^ (np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, len(p)).astype(np.uint64))
    both = np.concatenate([p, q])
    tree, shards = simhash.fit(both[::3], len(both), 4, 150)
    i, s, visitor = simhash.route(tree, both, 4)
    assert shards > 10 and (np.bincount(i[~visitor], minlength=len(both)) == 1).all()
    homes = dict(zip(i[~visitor].tolist(), s[~visitor].tolist()))
    at: dict = {}
    for a, b in zip(i.tolist(), s.tolist()):
        at.setdefault(a, set()).add(b)
    assert all(homes[k] in at[k + len(p)] or homes[k + len(p)] in at[k] for k in range(len(p)))


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 380)] + [(500, k) for k in range(501, 700)] + [(5, 5)]
    nodes = sorted({x for e in edges for x in e})
    pairs = {tuple(sorted(e)) for e in edges}
    want = brute_components(nodes, lambda a, b: (a, b) in pairs)
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: r for n, r in want.items() if n != r}
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_tables(spark):
    none = docs(spark, [])
    assert simhash.near_duplicates(none).count() == simhash.keep_unlike(none).count() == licenses.scan(none).count() == linededup.dedup(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(none, items).count() == decontaminate.contaminated(docs(spark, ["a"]), items).count() == 0
    assert decontaminate.clean(docs(spark, ["a"]), items).count() == 1


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "one two three four five"), (3, "one two three four five"), (None, "else")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {(None, 3), (3, 3), (None, None)}


def edit_distance_within(pattern, text):
    """The least edits of a copy of ``pattern`` anywhere in ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_copies_within_the_budget_are_found_and_no_others(spark):
    rng = random.Random(2)
    abc = "abcdefgh ij"
    item = lambda: decontaminate.normal("".join(rng.choices(abc, k=rng.randint(60, 200))))
    items = [(i, item()) for i in range(12)] + [(90, "short"), (91, None), (92, items0 := item()), (93, items0)]
    texts = [None, "", LONG]
    for _ in range(40):
        i, t = rng.choice(items[:12])
        s = list(t)
        for _ in range(rng.randint(0, 2 * decontaminate.budget(len(t)))):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [s[k], rng.choice("xyz")]])
        texts.append(item() + " " + "".join(s).upper() + "\n\n " + item())
    texts.append(items0)
    df = docs(spark, texts)
    rows = decontaminate.contaminated(df, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in rows}
    want = {}
    for d, t in enumerate(texts):
        t = decontaminate.normal(t)
        for i, p in items:
            p = decontaminate.normal(p)
            if t and t != decontaminate.normal(LONG) and len(p) >= decontaminate.Q and (e := edit_distance_within(p, t)) <= decontaminate.budget(len(p)):
                want[d, i] = e
    assert got == want and len(got) > 20
    for r in rows:
        span = decontaminate.normal(texts[r["doc_id"]])[r["span_start"] : r["span_end"]]
        assert edit_distance_within(decontaminate.normal(dict(items)[r["item_id"]]), span) == r["edits"]
    clean = {r["doc_id"] for r in decontaminate.clean(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in got}


def test_short_items_stand_as_whole_words(spark):
    items = spark.createDataFrame([(1, "Yes no"), (2, "x"), (3, ""), (4, None), (5, "yes  no")], "item_id long, text string")
    df = docs(spark, ["say YES  no, x now", "yes nope", "yes no", None, "x"])
    got = {(r["doc_id"], r["item_id"], r["edits"], r["span_start"], r["span_end"]) for r in decontaminate.contaminated(df, items).collect()}
    assert got == {(0, 2, 0, 12, 13), (2, 1, 0, 0, 6), (2, 5, 0, 0, 6), (4, 2, 0, 0, 1)}
    assert decontaminate.clean(df, items).count() == 5  # a word of the language drops no document


def test_repetitive_texts_are_counted_in_slices(monkeypatch):
    rng = random.Random(3)
    patterns = ["ha" * 50, "".join(rng.choices("abc", k=120))]
    index = grams.Index([(i, grams.codes(grams.points(p), 10), np.arange(len(p) - 9)) for i, p in enumerate(patterns)])
    code, widths = grams.codes(grams.points("ha" * 900 + patterns[1] + "ha" * 70), 10), np.array([9, 10])
    want = grams.bands(*index.hits(code), widths)
    slices = index.slices
    monkeypatch.setattr(index, "slices", lambda c: slices(c, 500))
    assert len(list(index.slices(code))) > 20
    assert all((a == b).all() for a, b in zip(want, index.bands(code, widths)))


@pytest.mark.parametrize("leaf", [1, 64, 1 << 12])
def test_a_shard_is_searched_by_a_tree(leaf):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    near = base[:150] ^ (np.uint64(1) << rng.integers(0, 63, 150).astype(np.uint64))
    points = np.concatenate([base, near, np.arange(64, dtype=np.uint64)])
    pairs = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4))}
    found, compared = set(), 0
    for h, a in simhash.leaves(points, points, 4, leaf):
        compared += len(h) * len(a)
        found |= {(int(h[x]), int(a[y])) for x, y in zip(*np.nonzero(np.bitwise_count(points[h][:, None] ^ points[a][None, :]) <= 4))}
    assert found == pairs and compared < 0.7 * len(points) ** 2


def test_the_root_is_cut_at_every_size():
    points = np.random.default_rng(1).integers(0, 2**63, 5_000, dtype=np.uint64)
    assert simhash.fit(points, 5_000)[1] > 1


def test_licenses_are_found_at_the_least_coverage():
    rng, scanner = random.Random(5), licenses.Scanner()
    words = ["alpha", "bravo", "tango", "kilo", "omega", "sigma", "delta"]
    for (name, _), text in licenses.TEMPLATES.items():
        own, hits = text.split(), []
        for _ in range(30):
            kept = set(rng.sample(range(len(own)), len(own) - int(0.2 * len(own))))
            copy = " ".join(w if i in kept else rng.choice(words) for i, w in enumerate(own))
            split = [licenses._WORD.findall(x.lower()) for x in (text, copy)]
            if (share := len(licenses.align(*split)) / len(split[0])) >= licenses.COVERAGE:
                doc = " ".join([*rng.choices(words, k=50), copy, *rng.choices(words, k=50)])
                # Without their version two licenses may fit alike; one is reported.
                hits.append(any(r[1] == name or r[3] >= share for r in scanner.find([doc])))
        assert sum(hits) >= 0.9 * len(hits) > 0


def test_line_dedup_of_a_table_with_its_own_names(spark):
    lines = [f"line {i} of {j}" for i in range(3) for j in range(2)]
    df = spark.createDataFrame([(i, f"shared boilerplate\n{lines[i]}\n{i}", f"s{i}", 1, 2, 3) for i in range(6)], "doc_id long, text string, source string, __bad int, __doc int, __removed int")
    out = linededup.dedup(df)
    assert out.columns == [*df.columns, "lines_removed"] and {(r["__bad"], r["__doc"], r["__removed"]) for r in out.collect()} == {(1, 2, 3)}


def test_items_in_blocks_give_the_same(spark):
    items = spark.createDataFrame([(i, f"item number {i} " + chr(97 + i) * 40) for i in range(9)], "item_id long, text string")
    df = docs(spark, [f"xx item number {i} " + chr(97 + i) * 40 for i in range(9)])
    key = lambda out: sorted(map(tuple, out.collect()))
    assert key(decontaminate.contaminated(df, items, block=60)) == key(decontaminate.contaminated(df, items))
    assert decontaminate.clean(df, items, block=60).count() == 0


@pytest.mark.parametrize("q", [1, 2, 5, 8, 10, 13])
def test_gram_codes_are_those_of_equal_grams(q):
    text = "abcabcabdabcabcabd" * 3
    codes = grams.codes(grams.points(text), q)
    by: dict = {}
    for i, c in enumerate(codes.tolist()):
        by.setdefault(c, set()).add(text[i : i + q])
    assert all(len(x) == 1 for x in by.values()) and len(by) == len({text[i : i + q] for i in range(len(codes))})


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT", "text"]
    words = mit.split()
    cut = " ".join(w for i, w in enumerate(words) if i % 12)
    line = "Licensed under the Apache License, Version 2.0"
    texts = [None, "", f"é before. {line}. after", mit, f"{cut}", f"{line}\n{line}", "the license of this is not known and under version 2 of it", LONG + line, "Released under the GPL", " ".join(words[: len(words) // 2])]
    rows = licenses.scan(docs(spark, texts)).collect()
    got = sorted((r["doc_id"], r["license_id"], r["template"], round(r["coverage"], 2)) for r in rows)
    assert got == [(2, "Apache-2.0", "line", 1.0), (3, "MIT", "text", 1.0), (4, "MIT", "text", got[2][3]), (5, "Apache-2.0", "line", 1.0), (5, "Apache-2.0", "line", 1.0), (7, "Apache-2.0", "line", 1.0)]
    assert 0.88 < got[2][3] < 0.95
    for r in rows:
        if r["template"] == "line":
            assert texts[r["doc_id"]][r["span_start"] : r["span_end"]] == line


def test_winnowing_keeps_a_gram_of_every_window():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 50, 300).astype(np.uint64)
    kept = licenses.winnow(codes, 5)
    assert all(((kept >= i) & (kept < i + 5)).any() for i in range(len(codes) - 4)) and len(licenses.winnow(codes[:0])) == 0


def test_line_dedup_agrees_with_exact_counts(spark):
    rng = random.Random(6)
    boiler, long = "Accept all cookies to go on", "passage " * 55
    copied = "\n".join(f"copied line {i}" for i in range(8))
    texts, sources = [], []
    for i in range(60):
        lines = [f"own line {i} {k}" for k in range(rng.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), f"  {boiler} ")
        if i in (7, 11, 13):
            lines.append(long)
        if i in (20, 22):
            lines.append("on two sites only, so it stays")
        texts.append("\n".join(lines))
        sources.append(f"site{i % 7}" if i % 5 else None)
    texts += [copied] * 12 + [None, "", "\n\n", boiler, LONG]
    sources += [f"site{i}" for i in range(12)] + [None, "a", "b", "c", "d"]
    df = docs(spark, texts, sources)
    got = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in linededup.dedup(df).collect()}
    c = duckdb.connect()
    c.sql("create table documents (doc_id bigint, text varchar, source varchar)")
    c.executemany("insert into documents values (?, ?, ?)", list(zip(range(len(texts)), texts, sources)))
    want = {r[0]: (r[1], r[2]) for r in c.sql(linededup.SQL).fetchall()}
    assert got == want
    assert boiler in got[0][0] and boiler not in got[3][0] and got[11][0].count("passage") == 0 and "on two sites" in got[22][0]
    assert all(got[60 + i] == (copied, 0) for i in range(12)) and got[72] == (None, 0)
    kept = {r["doc_id"] for r in linededup.keep(df).collect()}
    assert kept == set(range(len(texts))) - {75}
    assert linededup.dedup(df.withColumn("lines_removed", F.lit("x"))).columns == [*df.columns, "lines_removed"]


def test_lines_that_are_the_least_of_their_documents_go(spark):
    number = lambda x: hashlib.md5(x.encode()).hexdigest()[:15]
    low, next_ = sorted((f"boilerplate line {i}" for i in range(3_000)), key=number)[:2]
    own = [f"own text of page {i} with words enough" for i in range(12)]
    assert number(next_) < min(map(number, own))
    copied = "\n".join(f"copied line {i} of one text" for i in range(20))
    texts = [f"{low}\n{own[i]}\n{next_}" for i in range(12)] + [f"{copied}\nkept on {i}" for i in range(12)]
    df = docs(spark, texts, [f"site{i % 6}" for i in range(24)])
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(df).collect()}
    assert got == {r["doc_id"]: r["text"] for r in linededup.keep(df).collect()} == {0: texts[0], **{i: own[i] for i in range(1, 12)}, **{i: texts[i] for i in range(12, 24)}}


def test_line_dedup_runs_no_python(spark):
    plan = linededup.dedup(docs(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def _components(sets, least):
    """By brute force: for each set the least index that it can reach through pairs of that similarity."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= least * (len(sets[i]) + len(sets[j]) - both) or not sets[i] and not sets[j]:
                pairs += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], pairs


def test_similar_documents_are_joined(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3_000)]
    texts = [None, "", " ", "few words", "Few words"]
    for _ in range(30):  # families of near copies around the threshold, some of them large
        base = rng.choices(words, k=rng.randint(30, 160))
        for _ in range(rng.choice([1, 2, 6]) if len(texts) > 160 else 40):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    want, pairs = _components([set(simhash.shingles(t).tolist()) for t in texts], simhash.LIKE)
    df = docs(spark, texts).withColumn("key", F.lit(1)).withColumn("u", F.lit("x")).repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in simhash.alike(df, part=40).collect()}
    assert pairs >= 1_000 and len(got) == len(texts)
    joined = sum(got[i] == got[w] for i, w in enumerate(want) if i != w)
    assert joined >= 0.99 * sum(i != w for i, w in enumerate(want))
    assert all(want[i] == want[c] for i, c in got.items())  # nothing is joined that has no chain of pairs


def test_fingerprints_bring_together_what_shares_no_band(spark):
    """Eight of ten shingles in common, fingerprints four bits apart, and no band of minima in common."""
    words = " ".join(f"w23692x{i}" for i in range(12))
    texts = [f"{words} left", f"{words} right", "nothing of the kind is said in this one at all"]
    a, b, _ = (simhash._features(simhash.shingles(t)) for t in texts)
    assert ((a[1] ^ b[1]) & (2**64 - 1)).bit_count() == 4 and not set(a[3]) & set(b[3])
    assert {r["doc_id"]: r["component_id"] for r in simhash.alike(docs(spark, texts)).collect()} == {0: 0, 1: 0, 2: 2}
    assert [r["doc_id"] for r in simhash.keep_unlike(docs(spark, texts)).orderBy("doc_id").collect()] == [0, 2]


def test_pairs_that_fail_are_followed_by_others():
    """Sketches that look alike though the sets aren't: each round gives others, until none is left."""
    rng = np.random.default_rng(4)
    sketch = np.where(rng.random((60, simhash.MINIMA)) < 0.1, rng.integers(0, 255, (60, simhash.MINIMA)), 7).astype(np.uint8)
    fp, root = np.zeros(60, np.uint64), np.arange(60)
    tried, seen, count = np.zeros(0, np.int64), set(), 1
    while True:
        h, q = simhash.candidates((fp, sketch, root), (fp, sketch, root), True, 20, count, tried)
        if not len(h):
            break
        new = set(zip(h.tolist(), q.tolist()))
        assert not new & seen
        seen, count = seen | new, 2 * count
        tried = np.sort([a * 60 + b for a, b in seen])
    like = {(a, b) for b in range(60) for a in range(b) if (sketch[a] == sketch[b]).mean() >= simhash.LIKE_SKETCH}
    assert seen == like and count <= 128
