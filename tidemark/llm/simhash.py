"""SimHash near-duplicates, linked exactly through vantage-point trees.

Fingerprint: a document's lower-cased (A-Z only) words, cut at ASCII white
space, give overlapping 4-word shingles; each shingle's XXH64 votes on 64 bits
and a bit is set where more than half of the votes set it.  Two documents are
linked if their fingerprints differ in at most ``radius`` bits, and a
document's component is the smallest ``doc_id`` it can reach.

Search: a vantage-point tree is fitted to a bounded sample of the distinct
fingerprints.  Each node cuts the space into shells by Hamming distance from
its vantage point, each leaf is a shard.  A fingerprint lives in one shard; by
the triangle bound a link into another shell needs a distance within
``radius`` of the shell's edge, so boundary fingerprints also visit those
shards.  Within a shard the same goes on: the task that holds it picks vantage
points of its own, cuts by every distance, and compares pair by pair only what
the triangle bound leaves together.  Trees only steer the work: any tree gives
the same links, and a shard that turns out large is cut into blocks.

The pipeline's stage, :func:`keep_unlike`, links documents whose sets of 5-word
shingles have a Jaccard similarity of 0.8 or more.  Sets meet if the trees above
connect their fingerprints, or if they share a band of minima (at 0.8,
fingerprints may be 20 bits apart, and no tree prunes that far); fingerprints and
sketches take the chance meetings out, and the shingles themselves decide.  Of a large group not all pairs are
verified, but only as many as it takes: see :func:`alike`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import components, kept, store

SEED = 42
WORDS = 4
RADIUS = 4
#: Fingerprints on which the tree is fitted, at most.
SAMPLE = 20_000
#: Fingerprints of a shard that are wanted (the root is cut at any size), and of a block into which a larger shard or its visitors are cut.
SHARD, BLOCK = 131_072, 131_072
#: Pairs of a leaf that are compared one by one, within a task.
LEAF = 1 << 17
_VOTES = 1 << 16
#: The stage's shingles, the similarity that links, and the radius of its candidates.
LIKE_WORDS, LIKE, WIDE = 5, 0.8, 20
#: Minima of a set, and of a band: sets of similarity 0.8 share none of the 16 bands by a chance of 0.0002.
MINIMA, BAND = 64, 4
#: The similarity by sketch (a byte of each minimum) under which a candidate is one by chance.
LIKE_SKETCH = 0.6
#: Sets of a group that are compared in one task; a larger group is cut into parts, and a task gets two of them.
PART = 4_096
#: Links whose components one task finds.
SMALL = 200_000
_MULTIPLIERS, _ADDENDS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, MINIMA), np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint as an unsigned integer; without any word it is 0."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), _VOTES):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _VOTES].tolist(), ends[at : at + _VOTES].tolist())], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprints as signed 64-bit integers."""
    kept.of("simhash")
    for s in texts:
        yield pd.Series(np.array([fingerprint(t) for t in s], np.uint64).view(np.int64))


def hexed(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Node:
    """``vantage`` and the shells' upper edges ``cuts``, or a leaf with its ``shard`` number."""

    def __init__(self, vantage=None, cuts=(), kids=(), shard=None):
        self.vantage, self.cuts, self.kids, self.shard = vantage, cuts, kids, shard


def fit(sample: np.ndarray, total: int, radius: int = RADIUS, shard: int = SHARD) -> tuple[Node, int]:
    """A tree on ``sample`` of ``total`` fingerprints, and its number of shards."""
    rng, count = np.random.default_rng(7), 0
    scale = max(1.0, total / max(1, len(sample)))

    def grow(points: np.ndarray, depth: int) -> Node:
        nonlocal count
        cuts: list[int] = []
        if (len(points) * scale > shard or not depth) and len(points) >= 32 and depth < 12:
            tried = rng.choice(points, min(8, len(points)), replace=False)
            vantage = max(tried, key=lambda v: np.bitwise_count(points ^ v).astype(float).var())
            far = np.bitwise_count(points ^ vantage).astype(int)
            lo, hi = np.quantile(far, [0.08, 0.92])
            cuts = list(range(int(lo), int(hi) + 1, radius + 1))
            cuts = [c for c in cuts if (far <= c).any() and (far > c).any()]
        if not cuts:
            count += 1
            return Node(shard=count - 1)
        edges = [-1, *cuts, 64]
        return Node(vantage, cuts, [grow(points[(far > a) & (far <= b)], depth + 1) for a, b in zip(edges, edges[1:])])

    return grow(np.unique(sample), 0), count


def route(tree: Node, points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of point, shard, is a visitor) for each point's home and each shard it must visit."""
    out: list[tuple[np.ndarray, int, bool]] = []

    def go(node: Node, home: np.ndarray, visit: np.ndarray) -> None:
        if not len(home) and not len(visit):
            return
        if node.shard is not None:
            out.append((home, node.shard, False))
            out.append((visit, node.shard, True))
            return
        h = np.bitwise_count(points[home] ^ node.vantage).astype(int)
        v = np.bitwise_count(points[visit] ^ node.vantage).astype(int)
        edges = [-1, *node.cuts, 64]
        for kid, a, b in zip(node.kids, edges, edges[1:]):
            # Of a pair across an edge the nearer one visits, so one side is enough.
            over = home[(h <= a) & (h + radius > a)]
            go(kid, home[(h > a) & (h <= b)], np.concatenate([over, visit[(v + radius > a) & (v - radius <= b)]]))

    all_ = np.arange(len(points))
    go(tree, all_, all_[:0])
    n = [len(i) for i, _, _ in out]
    return (np.concatenate([i for i, _, _ in out] or [all_]), np.repeat([s for _, s, _ in out], n).astype(np.int32), np.repeat([v for _, _, v in out], n).astype(bool))


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if (up == label).all():
            return label
        label = up


def leaves(home: np.ndarray, asked: np.ndarray, radius: int, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays (of ``home``, of ``asked``) that together hold every pair within ``radius``, by a vantage-point tree."""
    rng = np.random.default_rng(11)
    stack = [(np.arange(len(home)), np.arange(len(asked)))]
    while stack:
        h, a = stack.pop()
        if not len(h) or not len(a):
            continue
        parts = None
        if len(h) * len(a) > leaf and len(h) > 1:
            # The point that tells most apart, of a few; copies of one fingerprint can't be told apart by any.
            tried = home[h[rng.integers(0, len(h), 8)]]
            few = home[h[rng.integers(0, len(h), 256)]]
            vantage = max(tried, key=lambda v: np.bitwise_count(few ^ v).astype(float).var())
            parts = np.bitwise_count(home[h] ^ vantage).astype(np.int16), np.bitwise_count(asked[a] ^ vantage).astype(np.int16)
        if parts is None or parts[0].min() == parts[0].max():
            if parts is not None:
                a = a[np.abs(parts[1] - parts[0][0]) <= radius]
            yield h, a
            continue
        (dh, da), by_h, by_a = parts, np.argsort(parts[0], kind="stable"), np.argsort(parts[1], kind="stable")
        at = np.unique(dh)
        ends = np.searchsorted(dh[by_h], at, "left"), np.searchsorted(dh[by_h], at, "right"), np.searchsorted(da[by_a], at - radius, "left"), np.searchsorted(da[by_a], at + radius, "right")
        stack += [(h[by_h[i:j]], a[by_a[k:m]]) for i, j, k, m in zip(*ends)]


def join_within(home: np.ndarray, asked: np.ndarray, radius: int, leaf: int = LEAF, tally: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what pairs within ``radius`` connect, at most one for each point; ``tally`` gets the pairs compared."""
    both = np.unique(np.concatenate([home, asked]))
    label, at_home, at_asked = np.arange(len(both)), np.searchsorted(both, home), np.searchsorted(both, asked)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merge() -> None:
        nonlocal label, found, size
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            while len(a):
                label = _roots(label)
                a, b = label[a], label[b]
                differ = a != b
                a, b = a[differ], b[differ]
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            found, size = [], 0

    for h, a in leaves(home, asked, radius, leaf):
        if tally is not None:
            tally.append(len(h) * len(a))
        rows = max(1, (1 << 19) // max(1, len(h)))
        for i in range(0, len(a), rows):
            q, k = np.nonzero(np.bitwise_count(asked[a[i : i + rows], None] ^ home[None, h]) <= radius)
            x, y = at_asked[a[i + q]], at_home[h[k]]
            found.append((x[x != y], y[x != y]))
            size += len(found[-1][0])
            if size > 1 << 19 or len(found) > 1 << 14:
                merge()
    merge()
    label = _roots(label)
    moved = label != np.arange(len(both))
    return both[moved], both[label[moved]]


def links(fps: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Distinct ``fps(fp bigint)`` -> edges ``(u, v)`` with the components of all links within ``radius``."""
    spark = fps.sparkSession
    total = fps.count()
    few = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    tree, _ = fit(np.array(few, np.int64).view(np.uint64), total, radius, shard)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept.of("simhash")
        for f in frames:
            fp = f["fp"].to_numpy(np.int64)
            for at in range(0, len(fp), 10_000):
                part = fp[at : at + 10_000]
                i, s, v = route(tree, part.view(np.uint64), radius)
                yield pd.DataFrame({"fp": part[i], "shard": s, "visitor": v})

    routed = store.table(fps.mapInPandas(spread, "fp bigint, shard int, visitor boolean"), "routed")
    # One row a shard, and the tree has no more shards than its sample has points.
    sizes = {r["shard"]: (r["h"], r["n"]) for r in routed.groupBy("shard").agg(F.count_if(~F.col("visitor")).alias("h"), F.count("*").alias("n")).collect()}
    cut = [(s, -(-h // BLOCK), -(-n // BLOCK)) for s, (h, n) in sizes.items() if h and n > 1]
    blocks = F.broadcast(spark.createDataFrame(cut, "shard int, by_home int, by_asked int"))
    dealt = routed.join(blocks, "shard").withColumns({"x": F.pmod(F.xxhash64("fp"), F.col("by_home")), "y": F.pmod(F.xxhash64("fp", F.lit(1)), F.col("by_asked"))})
    grid = lambda a, b: F.sequence(a, b - 1)
    home = dealt.where(~F.col("visitor")).select("shard", "x", F.explode(grid(F.lit(0).cast("long"), F.col("by_asked").cast("long"))).alias("y"), "fp", F.lit(True).alias("home"))
    asked = dealt.select("shard", F.explode(grid(F.lit(0).cast("long"), F.col("by_home").cast("long"))).alias("x"), "y", "fp", F.lit(False).alias("home"))

    def block(f: pd.DataFrame) -> pd.DataFrame:
        at_home = f["home"].to_numpy(bool)
        fp = f["fp"].to_numpy(np.int64).view(np.uint64)
        u, v = join_within(fp[at_home], fp[~at_home], radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return home.unionByName(asked).groupBy("shard", "x", "y").applyInPandas(block, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """``docs(doc_id, text)`` -> one row for each row: doc_id, fingerprint, component_id.

    Null and empty texts, and texts of white space only, have fingerprint zero
    and are linked like any other.  Repeated rows stay repeated; a null doc_id
    is kept and never names a component unless all its members are null.  Every
    word of a text counts, however long it is.  An empty table gives an empty
    table; other columns are ignored.
    """
    own = store.table(docs.select("doc_id", fingerprint_udf(F.col("text")).alias("fp")), "fingerprints")
    first = store.table(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    near = components.connected(links(first.select("fp"), radius, sample, shard))
    rooted = first.join(near.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", hexed("fp").alias("fingerprint"), "component_id")


def shingles(text: str | None, words: int = LIKE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a text of fewer words is one shingle, one without words has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = (starts[: 1 - words], ends[words - 1 :]) if len(found) > words else (starts[:1], ends[-1:])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """Of a set of shingles, the least values under ``MINIMA`` hash functions."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            np.minimum(out, (hashes[at : at + 4096, None] * _MULTIPLIERS + _ADDENDS).min(0), out)
    return out >> np.uint64(16)


def _features(hashes: np.ndarray) -> tuple[int, int, bytes, list[int]]:
    """Of a set of shingles: a number for the set, its fingerprint, its sketch (a byte of each minimum), and its bands; an empty set has none."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _VOTES):
        votes += np.unpackbits(hashes[at : at + _VOTES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    fp = int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])
    signed = lambda x, seed: int(np.uint64(xxhash.xxh64_intdigest(x.tobytes(), seed)).view(np.int64))
    if not len(hashes):
        return signed(hashes, SEED), fp, bytes(MINIMA), []
    least = minima(hashes)
    return signed(hashes, SEED), fp, (least & np.uint64(255)).astype(np.uint8).tobytes(), [signed(least[k : k + BAND], k) for k in range(0, MINIMA, BAND)]


@F.pandas_udf(T.StructType([T.StructField("sig", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]))
def _features_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    kept.of("simhash")  # nothing, but what other operators keep goes
    for s in texts:
        yield pd.DataFrame([_features(shingles(t)) for t in s], columns=["sig", "fp", "sketch", "bands"])


@F.pandas_udf(T.BinaryType())
def _shingles_udf(texts: pd.Series) -> pd.Series:
    """Shingles by 32 bits of their hashes."""
    kept.of("simhash")
    return pd.Series([np.unique(shingles(t).astype("<u4")).tobytes() for t in texts])


@F.pandas_udf(T.DoubleType())
def _jaccard_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    kept.of("simhash")
    out = []
    for x, y in zip(a, b):
        x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / max(1, len(x) + len(y) - both))
    return pd.Series(out, dtype=float)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Which edges are in the spanning forest of ``n`` nodes that takes the first edges (Boruvka's rounds)."""
    chosen, label, live = np.zeros(len(i), bool), np.arange(n), np.arange(len(i))
    while True:
        a, b = label[i[live]], label[j[live]]
        apart = a != b
        live, a, b = live[apart], a[apart], b[apart]
        if not len(live):
            return chosen
        best = np.full(n, len(i))
        np.minimum.at(best, a, live)
        np.minimum.at(best, b, live)
        took = np.unique(best[best < len(i)])
        chosen[took] = True
        a, b = label[i[took]], label[j[took]]
        while len(a):
            label = _roots(label)
            a, b = label[a], label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        label = _roots(label)


def _forests(i: np.ndarray, j: np.ndarray, like: np.ndarray, n: int, count: int) -> np.ndarray:
    """Which edges are in the first ``count`` spanning forests, each of the likest edges that are left."""
    left, out = np.argsort(-like, kind="stable"), [np.zeros(0, np.int64)]
    for _ in range(count):
        if not len(left):
            break
        chosen = _forest(i[left], j[left], n)
        out.append(left[chosen])
        left = left[~chosen]
    return np.concatenate(out)


def candidates(home: tuple, asked: tuple, same: bool, radius: int, count: int, tried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (home, asked) of (fingerprints, sketches, roots) that may be alike, as indexes, but for those ``tried`` (home * len(asked) + asked, sorted).

    Only pairs of different roots, and of these ``count`` spanning forests of
    the roots: more would be of no use if these hold.  ``same``: both are one.
    """
    (fp, sketch, root), (fp2, sketch2, root2) = home, asked
    names, number = np.unique(np.concatenate((root, root2)), return_inverse=True)
    number, number2 = number[: len(root)], number[len(root) :]
    got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    rows, size = max(1, (1 << 16) // max(1, len(fp))), 0
    parts: list[list[np.ndarray]] = []

    def thin() -> list[np.ndarray]:
        h, q, like = (np.concatenate(x) for x in zip(got, *parts))
        kept = _forests(number[h], number2[q], like, len(names), count)
        return [h[kept], q[kept], like[kept]]

    for i in range(0, len(fp2), rows):
        q, h = np.nonzero((np.bitwise_count(fp2[i : i + rows, None] ^ fp[None, :]) <= radius) & (number2[i : i + rows, None] != number[None, :]))
        q += i
        if same:
            q, h = q[h < q], h[h < q]
        if len(tried) and len(q):
            code = h * len(fp2) + q
            fresh = tried[np.minimum(np.searchsorted(tried, code), len(tried) - 1)] != code
            q, h = q[fresh], h[fresh]
        for at in range(0, len(q), 1 << 14):
            a, b = h[at : at + (1 << 14)], q[at : at + (1 << 14)]
            like = (sketch[a] == sketch2[b]).mean(1)
            good = like >= LIKE_SKETCH
            if good.any():
                parts.append([a[good], b[good], like[good]])
                size += int(good.sum())
        if size > 1 << 17:
            got, parts, size = thin(), [], 0
    got = thin()
    return got[0], got[1]


def by_fingerprint(sets: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``sets(sig, fp)`` -> sig, key: one key for all whose fingerprints links within ``radius`` connect, as in :func:`near_duplicates`."""
    near = components.connected(links(store.table(sets.select("fp").distinct(), "distinct"), radius), SMALL)
    return sets.join(near.withColumnRenamed("node", "fp"), "fp", "left").select("sig", F.xxhash64(F.coalesce("root", "fp")).alias("key"))


def _neighbours(members: DataFrame) -> DataFrame:
    """``u, v``: sets that follow each other within a group, in an order that spreads any group over tasks."""

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for f in frames:
            key, sig = f["key"].to_numpy(np.int64), f["sig"].to_numpy(np.int64)
            if last is not None and len(key):
                key, sig = np.append(last[0], key), np.append(last[1], sig)
            if len(key):
                last = key[-1], sig[-1]
            pair = key[1:] == key[:-1]
            yield pd.DataFrame({"u": np.minimum(sig[1:], sig[:-1])[pair], "v": np.maximum(sig[1:], sig[:-1])[pair]})

    return members.select("key", "sig").repartitionByRange("key", "sig").sortWithinPartitions("key", "sig").mapInPandas(link, "u bigint, v bigint").distinct()


def _met(open_: DataFrame, tried: DataFrame, radius: int, count: int) -> DataFrame:
    """``key, a, b, u, v``: pairs of different roots that may be alike, of each part of each group that has several roots.

    ``open_(key, a, b, x, sig, fp, sketch, root)`` are the members of the parts,
    ``tried(key, a, b, u, v)`` what was found before.  Groups come sorted to a
    task, many small ones to each batch; a part is bounded, so it is held.
    """

    def part(a: int, b: int, x: np.ndarray, sig: np.ndarray, fp: np.ndarray, sketch: np.ndarray, root: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.flatnonzero(x == a), np.flatnonzero(x == b)
        done = np.zeros(0, np.int64)
        if len(u) and len(i) and len(j):
            place = lambda s, at: np.minimum(np.searchsorted(sig[at], s), len(at) - 1)
            done = np.concatenate([(place(p, i) * len(j) + place(q, j))[(sig[i][place(p, i)] == p) & (sig[j][place(q, j)] == q)] for p, q in ((u, v), (v, u))])
        h, q = candidates((fp[i], sketch[i], root[i]), (fp[j], sketch[j], root[j]), a == b, radius, count, np.sort(done))
        return np.minimum(sig[i][h], sig[j][q]), np.maximum(sig[i][h], sig[j][q])

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept.of("simhash")
        rest = None
        for f in chain(frames, [None]):
            now = rest if f is None else f if rest is None else pd.concat([rest, f], ignore_index=True)
            if now is None or not len(now):
                continue
            key, a, b = (now[c].to_numpy(np.int64) for c in ("key", "a", "b"))
            starts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1))
            ends = np.append(starts[1:], len(key))
            if f is not None:  # the last group may go on
                rest, starts, ends = now.iloc[starts[-1] :], starts[:-1], ends[:-1]
            x, sig, root, fp, member = (now[c].to_numpy(np.int64) for c in ("x", "sig", "root", "fp", "member"))
            sketches, out = now["sketch"].to_numpy(), []
            for s, e in zip(starts.tolist(), ends.tolist()):
                m = s + int(member[s:e].sum())  # members come first, in the order of sig; a tried pair has its u and v as sig and root
                if m > s:
                    sketch = np.frombuffer(b"".join(sketches[s:m]), np.uint8).reshape(-1, MINIMA)
                    u, v = part(int(a[s]), int(b[s]), x[s:m], sig[s:m], fp[s:m].view(np.uint64), sketch, root[s:m], sig[m:e], root[m:e])
                    out.append((np.full(len(u), key[s]), np.full(len(u), a[s]), np.full(len(u), b[s]), u, v))
            if out:
                yield pd.DataFrame(dict(zip(("key", "a", "b", "u", "v"), map(np.concatenate, zip(*out)))))

    own = open_.select("key", "a", "b", F.lit(1).alias("member"), "x", "sig", "fp", "sketch", "root")
    before = tried.select("key", "a", "b", F.lit(0).alias("member"), F.lit(0).alias("x"), F.col("u").alias("sig"), F.lit(0).cast("bigint").alias("fp"), F.lit(b"").cast("binary").alias("sketch"), F.col("v").alias("root"))
    dealt = own.unionByName(before).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", F.desc("member"), "sig")
    return dealt.mapInPandas(compare, "key bigint, a int, b int, u bigint, v bigint")


def alike(docs: DataFrame, radius: int = WIDE, least: float = LIKE, part: int = PART) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, component_id: linked by the Jaccard similarity of their shingles.

    Equal sets are one from the start.  Sets whose fingerprints are connected, and
    sets that share a band, meet.  First those
    that stand next to each other in a group are verified, which ties most groups
    of copies together at a linear cost.  Then, round by round, groups that still
    have several components are compared, and of the pairs that may be alike and
    join different components, four spanning forests are verified, then 16, then
    64; a round that finds no pair is the last.  So every pair that meets is
    either verified, or unlike by its sketch, or joined already.

    Texts without any word are alike, and like no other.  Null texts are empty.
    A null doc_id names a component only if all its members are null; repeated
    rows are copies; no rows give no rows; whole texts count, however long; other
    columns are ignored.
    """
    own = store.table(docs.select("doc_id", F.xxhash64("text").alias("whole"), _features_udf("text").alias("x")).select("doc_id", "whole", "x.*"), "features")
    first = store.table(own.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.min("whole").alias("whole"), F.min("fp").alias("fp"), F.min("sketch").alias("sketch"), F.min("bands").alias("bands")), "sets")
    banded = first.select("sig", F.explode("bands").alias("key")).unionByName(by_fingerprint(first.where("size(bands) > 0")))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = store.table(banded.join(shared, "key"), "members")
    wanted = members.select("sig").distinct()
    texts = docs.select(F.xxhash64("text").alias("whole"), "text").join(first.join(wanted, "sig").select("whole", "sig"), "whole").groupBy("sig").agg(F.min("text").alias("text"))
    sets = store.table(texts.select("sig", _shingles_udf("text").alias("s")), "shingles")

    def held(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("sig").alias("u"), F.col("s").alias("su")), "u").join(sets.select(F.col("sig").alias("v"), F.col("s").alias("sv")), "v")
        return both.select("u", "v", _jaccard_udf("su", "sv").alias("j")).where(F.col("j") >= least).select("u", "v")

    near = store.table(components.connected(held(_neighbours(members)), SMALL), "roots")
    none, count, waiting = "key bigint, a int, b int, u bigint, v bigint", 4, members
    tried = docs.sparkSession.createDataFrame([], none)
    while True:
        rooted = waiting.join(near.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        several = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
        open_ = rooted.join(several, "key").join(first.select("sig", "fp", "sketch"), "sig")
        parts = F.ceil(F.col("n") / part).cast("int")
        dealt = open_.withColumn("x", F.pmod(F.xxhash64("sig"), parts).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), parts - 1))).withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")})
        met = store.table(_met(dealt.select("key", "a", "b", "x", "sig", "fp", "sketch", "root"), tried, radius, count), "met")
        if met.limit(1).count() == 0:
            break
        # What is new joins components as they were, so only their roots are joined, and what had a root before gets that one's.
        root = lambda c: near.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
        found = held(met.select("u", "v").distinct()).join(root("u"), "u", "left").join(root("v"), "v", "left")
        fresh = store.table(components.connected(found.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")), SMALL), "joined")
        moved = near.join(fresh.select(F.col("node").alias("root"), F.col("root").alias("__to")), "root", "left").select("node", F.coalesce("__to", "root").alias("root"))
        near = store.table(moved.unionByName(fresh), "roots")
        tried = store.table(tried.unionByName(met).join(met.select("key").distinct(), "key", "left_semi"), "tried")
        waiting, count = members.join(met.select("key").distinct(), "key"), 4 * count
    rooted = first.select("sig", "first_id").join(near.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("sig", "component_id")
    return own.select("doc_id", "sig").join(named, "sig").select("doc_id", "component_id")


def keep_unlike(docs: DataFrame, radius: int = WIDE, least: float = LIKE) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component by :func:`alike`, all columns as they are.

    Repeated rows of that doc_id stay; rows with a null doc_id go unless their
    whole component has none.
    """
    kept = alike(docs, radius, least).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
