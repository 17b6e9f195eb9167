"""Periodic runs of words, by the method of Gusfield and Stoye.

A run is a longest stretch of words with a period; it is wanted where it has
``LEAST`` words and three periods or more.  The words of many documents are
numbered document by document, so that one sequence holds them all and no
repeat crosses a border, and then:

1.  Factors of 1, 2, 4, ... words are named in order.  The names give the suffix
    array, and how far any two places agree, forwards or backwards.
2.  The Lempel-Ziv blocks of the sequence, each compared around its end and its
    start, give squares (``xx``) that cover the leftmost place of each square.
3.  Each is put on the suffix tree, and suffix links are walked from there as
    long as the square goes on turning (``axax`` to ``xaxa``), until a square
    that is marked already: then the vocabulary of squares is complete.
4.  The leaves below a mark are the square's places; places that follow each
    other with one period are one run.

Squares whose half is a repeat itself tell of no other runs and are left out
before the walks, so places are few and no unary text is quadratic.  Naming
takes a sort for each doubling, so time is linear but for a logarithm; memory
is a few numbers per word and doubling.

Documents don't enter step 1 whole: each group of ``GRAM`` words in a run comes
again a period on, so only stretches in which every such group occurs twice in
its document can hold a run.  That filter loses nothing: equal groups have
equal hashes, and what only looks equal is told apart in step 1.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words and periods that a run has at least.
LEAST, TIMES = 24, 3
#: Words in the groups of the filter. A run has two periods and GRAM - 1 words at least, as 3 q >= 2 q + 7 from q = 7 on and 24 >= 2 q + 7 below.
GRAM = 8
#: Words that are searched together, but for a longer document.
POOL = 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def stretches(words: list[bytes]) -> list[tuple[int, int]]:
    """Parts of a document (start, end) outside which there is no run."""
    n = len(words)
    if n < LEAST:
        return []
    grams, step, mix = np.fromiter(map(hash, words), np.int64, n).view(np.uint64), 1, _MIX
    with np.errstate(over="ignore"):
        while step < GRAM:
            grams = grams[:-step] * mix + grams[step:]
            step, mix = step * 2, mix * mix
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) < LEAST - GRAM - GRAM + 1:
        return []
    at = np.flatnonzero(np.diff(np.concatenate(([0], np.isin(grams, twice).view(np.int8), [0]))))
    return [(int(a), int(b) + GRAM - 1) for a, b in at.reshape(-1, 2) if b - a >= LEAST - GRAM + 1]


class Sequence:
    """A sequence of numbers: names of its factors, its suffix tree and its runs.

    The last number must occur nowhere else.
    """

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        name = np.unique(symbols, return_inverse=True)[1]
        self.symbols = name
        #: By level k: the name of the factor of 2**k numbers at each place, and one entry for what is outside.
        self.names = []
        while True:
            self.names.append(np.append(name, -1).astype(np.int32))
            if name.max() == n - 1:
                break
            ahead = np.zeros(n, np.int64)
            step = 1 << (len(self.names) - 1)
            ahead[: n - step] = name[step:] + 1
            name = np.unique(name * np.int64(n + 1) + ahead, return_inverse=True)[1]
        self.rank = name
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[name] = np.arange(n)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Numbers that agree from places i and j on, i < j."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 2, -1, -1):
            step = np.where(self.names[k][i] == self.names[k][np.minimum(j, self.n)], 1 << k, 0)
            i, j, out = i + step, j + step, out + step
        return out

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Numbers that agree up to places i and j (their own included), i < j."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 2, -1, -1):
            a, b = i - (1 << k) + 1, j - (1 << k) + 1
            step = np.where((a >= 0) & (self.names[k][np.maximum(a, 0)] == self.names[k][np.maximum(b, 0)]), 1 << k, 0)
            i, j, out = i - step, j - step, out + step
        return out

    def blocks(self) -> np.ndarray:
        """Starts of the Lempel-Ziv blocks: longest factors that begin earlier too, or one number."""
        n, order = self.n, self.suffixes.tolist()
        left, right, stack = [-1] * n, [-1] * n, []
        for place in order:  # the nearest suffixes on both sides that begin earlier
            while stack and stack[-1] > place:
                right[stack.pop()] = place
            left[place] = stack[-1] if stack else -1
            stack.append(place)
        here, longest = np.arange(n), np.zeros(n, np.int64)
        for side in (np.array(left), np.array(right)):
            has = np.flatnonzero(side >= 0)
            longest[has] = np.maximum(longest[has], self.ahead(side[has], here[has]))
        jumps, out, at = np.maximum(longest, 1).tolist(), [], 0
        while at < n:
            out.append(at)
            at += jumps[at]
        return np.array(out, np.int64)

    def covering(self) -> tuple[np.ndarray, np.ndarray]:
        """Squares (start, half) among which the leftmost place of every square is covered by turning one of them."""
        start = self.blocks()
        end = np.append(start[1:], self.n)
        size, then = end - start, np.append(end[1:], self.n)

        def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            block = np.repeat(np.arange(len(counts)), counts)
            return block, np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts) + 1

        found = []
        b, half = spread(size)  # the square's second half holds the block's end
        at, pair = end[b], end[b] - half
        ok = (at < self.n) & (self.symbols[np.minimum(at, self.n - 1)] == self.symbols[pair])
        found.append((at[ok], pair[ok], half[ok], pair[ok]))
        b, half = spread(then - start)  # its first half holds the block's start
        at, pair = start[b], start[b] + half
        ok = (at > 0) & (pair < self.n)
        at, pair, half = at[ok], pair[ok], half[ok]
        ok = self.symbols[at - 1] == self.symbols[pair - 1]
        found.append((pair[ok], at[ok], half[ok], at[ok]))
        starts, halves = [], []
        for later, earlier, half, mid in found:
            on = self.ahead(earlier, later)
            left = np.zeros(len(on), np.int64)
            inner = np.flatnonzero(earlier > 0)
            left[inner] = self.back(earlier[inner] - 1, later[inner] - 1)
            ok = (on + left >= half) & (on > 0)
            starts.append(np.maximum(mid - left, mid - half + 1)[ok])
            halves.append(half[ok])
        return np.concatenate(starts), np.concatenate(halves)

    def primitive(self, start: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Whether the half of each square is no repeat of a shorter word."""
        out = np.ones(len(start), bool)
        most = int(half.max(initial=1))
        prime = np.arange(most + 1)  # the least prime factor of each number
        for p in range(2, int(most**0.5) + 1):
            if prime[p] == p:
                own = prime[p * p :: p]
                own[own == np.arange(p * p, most + 1, p)] = p
        rest, live = half.copy(), np.flatnonzero(half > 1)
        while len(live):
            i, h, p = start[live], half[live], prime[rest[live]]
            out[live] &= self.ahead(i, i + h // p) < h - h // p
            rest[live] //= p
            live = live[out[live] & (rest[live] > 1)]
        return out

    def tree(self) -> None:
        """Inner nodes by their range of leaves, and for each node (leaves from ``n`` places on) its parent, depth and suffix link."""
        n, order = self.n, self.suffixes
        shared = np.zeros(n + 1, np.int64)
        a, b = np.minimum(order[:-1], order[1:]), np.maximum(order[:-1], order[1:])
        shared[1:n] = self.ahead(a, b)
        depth, first, last, parent, leaf = [0], [0], [n - 1], [0], [0] * n
        stack = [0]
        for r, s in enumerate(shared[1:].tolist()):  # s: what leaf r shares with the next one
            low, node = r, None
            while depth[stack[-1]] > s:
                done = stack.pop()
                last[done], low = r, first[done]
                if node is not None:
                    parent[node] = done
                elif leaf[r] == 0:
                    leaf[r] = done
                node = done
            if depth[stack[-1]] < s:
                depth.append(s), first.append(low), last.append(n - 1), parent.append(0)
                stack.append(len(depth) - 1)
            if node is not None:
                parent[node] = stack[-1]
            if leaf[r] == 0:
                leaf[r] = stack[-1]
        inner = len(depth)
        self.inner = inner
        self.first = np.concatenate((np.array(first), np.arange(n)))
        self.last = np.concatenate((np.array(last), np.arange(n)))
        self.depth = np.concatenate((np.array(depth), n - order))
        self.parent = np.concatenate((np.array(parent), np.array(leaf))).astype(np.int32)
        self.up = [self.parent]
        while (self.up[-1] != 0).any():
            self.up.append(self.up[-1][self.up[-1]])
        at = order[self.first[1:inner]] + 1
        self.link = np.zeros(inner, np.int64)
        self.link[1:] = np.where(self.depth[1:inner] > 1, self.locus(np.minimum(at, n - 1), self.depth[1:inner] - 1), 0)

    def locus(self, place: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The highest nodes on the ways to the suffixes at ``place`` that are ``length`` deep or more."""
        node = self.inner + self.rank[place]
        for up in reversed(self.up):
            above = up[node]
            node = np.where(self.depth[above] >= length, above, node)
        return node

    def squares(self) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary of squares with primitive halves: nodes at or above whose end they end, and halves."""
        start, half = self.covering()
        ok = self.primitive(start, half)
        start, half = start[ok], half[ok]
        if not len(start):
            return start, half
        self.tree()
        seeds = self.locus(start, 2 * half)
        symbols, order, n = self.symbols.tolist(), self.suffixes.tolist(), self.n
        first, depth, parent, link = self.first.tolist(), self.depth.tolist(), self.parent.tolist(), self.link.tolist()
        child = {}
        for v in range(1, len(depth)):
            child[parent[v], symbols[order[first[v]] + depth[parent[v]]]] = v
        marked = {}
        for node, size in set(zip(seeds.tolist(), (2 * half).tolist())):
            while (node, size) not in marked:
                marked[node, size] = True
                at = order[first[node]]
                turned, on, to = symbols[at], at + 1, size - 1
                u = link[parent[node]]
                while depth[u] < to:
                    u = child[u, symbols[on + depth[u]]]
                if depth[u] == to:
                    u = child.get((u, turned))
                    if u is None:
                        break
                elif symbols[order[first[u]] + to] != turned:
                    break
                node = u
        nodes, sizes = np.array(list(marked), np.int64).reshape(-1, 2).T
        return nodes, sizes // 2

    def runs(self, least: int = LEAST, times: int = TIMES) -> list[Run]:
        """All runs (start, length, period) of ``least`` numbers and ``times`` periods (2 at least), by start and period."""
        nodes, half = self.squares()
        if not len(nodes):
            return []
        first, count = self.first[nodes], self.last[nodes] - self.first[nodes] + 1
        owner = np.repeat(np.arange(len(nodes)), count)
        places = self.suffixes[np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]]
        keys = np.unique(half[owner] * np.int64(self.n + 1) + places)
        breaks = np.flatnonzero(np.diff(keys) != 1) + 1
        a, b = keys[np.concatenate(([0], breaks))], keys[np.concatenate((breaks - 1, [len(keys) - 1]))]
        period, start = a // (self.n + 1), a % (self.n + 1)
        length = b % (self.n + 1) - start + 2 * period
        ok = np.flatnonzero((length >= least) & (length >= times * period))
        return sorted(zip(start[ok].tolist(), length[ok].tolist(), period[ok].tolist()), key=lambda r: (r[0], r[2]))


def find(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document (start, length, period), by start and period."""
    out: list[list[Run]] = [[] for _ in documents]
    parts, where, used, fresh = [], [], 0, 0

    def search() -> None:
        if parts:
            starts = np.array([w[0] for w in where])
            for start, length, period in Sequence(np.concatenate(parts)).runs():
                begin, doc, offset = where[int(np.searchsorted(starts, start, "right")) - 1]
                out[doc].append((start - begin + offset, length, period))
        parts.clear(), where.clear()

    for d, words in enumerate(documents):
        numbers: dict[bytes, int] = {}
        for a, b in stretches(words):
            own = np.fromiter((numbers.setdefault(w, fresh + len(numbers)) for w in words[a:b]), np.int64, b - a)
            where.append((used, d, a))
            parts.extend((own, np.array([-len(where)])))  # a number of its own after each stretch
            used += b - a + 1
        fresh += len(numbers)
        if used >= POOL:
            search()
            used, fresh = 0, 0
    search()
    return out


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of which a tenth of the documents repeat a part up to the end; which and how follows from ``doc_id``."""
    n = len(words)
    if not n or doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    keep, at = [], 0
    for a, b in sorted((s + q, s + length) for s, length, q in runs):
        keep += words[at : max(a, at)]
        at = max(at, b)
    return keep + words[at:] if runs else words


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods; of equals the first, then that with the shortest period."""
    best = None
    for r in runs:
        if best is None or (r[1] * best[2], -r[0], -r[2]) > (best[1] * r[2], -best[0], -best[2]):
            best = r
    return best


SCHEMA = "doc_id string, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def collapse(docs: DataFrame, loop: bool = False, text: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> a row for each row: runs, the strongest of them, and the text without repeats.

    Words are what stands between the six ASCII white spaces; whole texts are
    searched, however long.  Null and empty texts have no words and no runs.
    With ``loop``, :func:`looped` changes the words first (a null doc_id changes
    nothing).  ``collapsed`` is null without ``text``.  Repeated rows and
    doc_ids are searched like any other; no rows give no rows; other columns are
    ignored, whatever their names.  A row needs no other, so nothing is shuffled.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            begin, size, rows = 0, 0, []
            for i in range(len(texts)):  # no more than POOL words at a time, or one text
                words = (texts[i].as_py() or b"").split()
                rows.append(looped(words, ids[i]) if loop else words)
                size += len(words)
                if size >= POOL or i + 1 == len(texts):
                    yield answer(ids[begin : i + 1], rows)
                    begin, size, rows = i + 1, 0, []

    def answer(ids: list, rows: list[list[bytes]]) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in names}
        for doc_id, words, runs in zip(ids, rows, find(rows)):
            best = strongest(runs)
            kept = b" ".join(collapsed(words, runs))
            start, length, period = best or (None, None, None)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
            values = (
                None if doc_id is None else str(doc_id), len(runs), start, length, period, 1000 * length // period if best else None,
                hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest(), [dict(zip(("start", "length", "period"), r)) for r in runs], kept if text else None,
            )
            for column, value in zip(out.values(), values):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(run), pa.binary()]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return slim.mapInArrow(search, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("collapsed", F.col("collapsed").cast("string"))
