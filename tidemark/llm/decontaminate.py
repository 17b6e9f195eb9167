"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are lower-cased and their white space becomes single spaces.  An item of
``n`` characters may be copied with ``k = rate * n`` edits; each edit spoils at
most ``q`` of its ``n - q + 1`` grams and shifts the diagonal by one at most.
So a copy leaves at least ``n - q + 1 - k * q`` shared grams on ``k + 1``
neighbouring diagonals.  Shared grams are counted in overlapping diagonal
bands, bands that reach the bound are aligned within the band, and those that
need at most ``k`` edits are reported.  No copy within the budget is missed.
Items of fewer than ``q`` characters have no gram: they are searched as they
are, as whole words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import grams, kept, store

Q = 10
RATE = 0.08
#: Characters of benchmark items that one index holds; more items make more passes.
ITEMS = 16_000_000
#: Characters of documents searched at a time (a longer document is searched alone, whole).
CHUNK = 500_000
SCHEMA = "item_id long, edits int, similarity double, span_start long, span_end long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().replace("\0", " ").split())


def budget(n: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed for ``n`` characters: those that leave a shared gram for certain; -1 if none could."""
    return min(int(rate * n), (n - q) // q) if n >= q else -1


def banded(pattern: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int]:
    """(edits, end) of the best copy of ``pattern`` that begins on diagonals ``low .. low + width - 1``.

    Row ``i`` holds the cells of ``text`` from ``low + i - most`` on, ``most``
    cells beyond the start diagonals on either side.  Edits over ``most`` come
    back as ``most + 1``.
    """
    size = width + 2 * most
    step = np.arange(size)
    padded = np.full(len(text) + 2 * (size + len(pattern)), 0xFFFFFFFF, np.uint32)
    shift = size + len(pattern)
    padded[shift : shift + len(text)] = text
    base = low - most + shift
    # Free start: an alignment may begin at any text position of the band that exists.
    place = low - most + step
    row = np.where((place >= 0) & (place <= len(text)) & (step >= most) & (step < most + width), 0, most + 1)
    for i, c in enumerate(pattern):
        across = row + (padded[base + i : base + i + size] != c)  # cell j of row i+1 is text position low-most+i+1+j
        skip = np.full(size, most + 2)
        skip[:-1] = row[1:] + 1  # a pattern character without a partner
        row = np.minimum(across, skip)
        row = np.minimum(np.minimum.accumulate(row - step) + step, most + 1)
    place = low - most + len(pattern) + step
    row = np.where((place >= 0) & (place <= len(text)), row, most + 1)
    j = int(row.argmin())
    return int(row[j]), int(place[j])


def align(pattern: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int]:
    """(edits, start, end) of the best copy of ``pattern`` in the band."""
    near = max(0, low)
    at = text[near : low + width + len(pattern) - 1].tobytes().find(pattern.tobytes())
    if at >= 0 and at % 4 == 0:  # nothing beats no edits
        return 0, near + at // 4, near + at // 4 + len(pattern)
    edits, end = banded(pattern, text, low, width, most)
    if edits > most:
        return edits, 0, 0
    head = text[max(0, end - len(pattern) - most) : end][::-1]
    back, length = banded(pattern[::-1], head, 0, 1, most)
    return edits, end - (length if back <= edits else len(pattern)), end


class Searcher:
    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        known = [(i, normal(t)) for i, t in items]
        kept = [(i, grams.points(t)) for i, t in known if budget(len(t), q, rate) >= 0]
        self.short = ahocorasick.Automaton()
        brief: dict[str, list[int]] = {}
        for i, t in known:
            if t and budget(len(t), q, rate) < 0:
                brief.setdefault(t, []).append(i)
        for t, ids in brief.items():
            self.short.add_word(f" {t} ", (t, sorted(ids)))
        if brief:
            self.short.make_automaton()
        self.q, self.ids, self.items = q, [i for i, _ in kept], [p for _, p in kept]
        n = np.array([len(p) for p in self.items], np.int64)
        self.most = np.array([budget(int(k), q, rate) for k in n], np.int64)
        self.need = np.maximum(1, n - q + 1 - self.most * q)
        self.index = grams.Index([(i, grams.codes(p, q), np.arange(len(p) - q + 1)) for i, p in enumerate(self.items)])

    def find(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(place in ``texts``, item_id, edits, start, end): a row for each copy, none for a copy within a better one."""
        parts = [grams.points(t) for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts])
        whole = np.zeros(int(ends[-1]) if len(parts) else 0, np.uint32)  # zeros stand between the texts
        for p, e in zip(parts, ends):
            whole[e - 1 - len(p) : e - 1] = p
        item, low, count = self.index.bands(grams.codes(whole, self.q), self.most + 1)
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for i, d in sorted(zip(item[count >= self.need[item]].tolist(), low[count >= self.need[item]].tolist())):
            k, n = int(self.most[i]), len(self.items[i])
            middle = min(max(d + k + n // 2, 0), len(whole) - 1)
            doc = int(np.searchsorted(ends, middle, "right"))
            begin = int(ends[doc]) - 1 - len(parts[doc])
            edits, start, end = align(self.items[i], parts[doc], d - begin, 2 * (k + 1), k)
            if edits <= k:
                found.setdefault((doc, i), []).append((edits, start, end))
        for (doc, i), spans in sorted(found.items()):
            taken: list[tuple[int, int, int]] = []
            for e, a, b in sorted(spans):
                if all(b <= c or a >= d for _, c, d in taken):
                    taken.append((e, a, b))
                    yield doc, self.ids[i], e, a, b

    def find_short(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """The same for items of fewer than ``q`` characters: every place where one stands as whole words."""
        if len(self.short):
            for doc, t in enumerate(texts):
                for end, (item, ids) in self.short.iter(f" {t} "):
                    for i in ids:
                        yield doc, i, 0, end - len(item) - 1, end - 1


def contaminated(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE, block: int = ITEMS) -> DataFrame:
    """Copies of ``items(item_id, text)`` in ``docs(doc_id, text)``.

    One row per copy: doc_id, item_id, edits, similarity (1 - edits / length of
    the item), span_start and span_end in the document's normalised text.
    Items shorter than ``q`` characters are found where they stand as whole
    words, without edits; null and empty items match nothing, null and empty
    documents hold nothing, a text of any length is searched whole, repeated rows report again, and tables
    without rows give none.  Other columns are ignored.  Items are indexed in
    blocks of at most ``block`` characters (one item at least), each sent to
    all tasks, whatever the benchmark's size.
    """
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    blocks, out = _blocks(items, block), None
    for n, own in enumerate(blocks):
        shared, name = items.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()]), uuid.uuid4().hex

        def search(frames: Iterator[pd.DataFrame], shared=shared, name=name) -> Iterator[pd.DataFrame]:
            searcher, lengths = _searcher(name, shared, q, rate)
            for f in frames:
                ids = f["doc_id"].to_numpy()
                rows = [(ids[d], i, e, 1 - e / lengths[i], a, z) for d, i, e, a, z in _copies(searcher, f["text"], True)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "similarity", "span_start", "span_end"])

        found = slim.mapInPandas(search, f"doc_id string, {SCHEMA}")
        if len(blocks) > 1:  # the block is searched before the next one is read, and then it is dropped
            found = store.table(found, f"copies-{n}")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _blocks(items: DataFrame, block: int) -> list[DataFrame]:
    """The items, in blocks of about ``block`` characters."""
    known = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block))
    return [known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else known for b in range(blocks)]


def _searcher(name: str, shared: Broadcast, q: int, rate: float) -> tuple[Searcher, dict[int, int]]:
    """The index of a block and its items' lengths, made once in a Python process; only the last block's is kept."""
    held = kept.of("searcher")
    if name not in held:
        held.clear()
        held[name] = Searcher(shared.value, q, rate), {i: len(normal(t)) for i, t in shared.value}
    return held[name]


def _copies(searcher: Searcher, texts: pd.Series, short: bool) -> Iterator[tuple[int, int, int, int, int]]:
    """:meth:`Searcher.find` over many texts, some at a time; with ``short``, :meth:`Searcher.find_short` too."""
    batch, size, first = [], 0, 0
    for n, t in enumerate([*texts, None]):
        if size > CHUNK or n == len(texts):
            yield from ((first + d, *r) for d, *r in searcher.find(batch))
            if short:
                yield from ((first + d, *r) for d, *r in searcher.find_short(batch))
            batch, size, first = [], 0, n
        batch.append(normal(t))
        size += len(batch[-1])


def clean(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE, block: int = ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item, all columns as they are; see :func:`contaminated`.

    Items shorter than ``q`` characters, words of the language perhaps, drop no document.
    """
    blocks = _blocks(items, block)
    for n, own in enumerate(blocks):
        shared = items.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()])
        docs = docs.where(_free(shared, uuid.uuid4().hex, q, rate)(F.col("text")))
        if n + 1 < len(blocks):
            docs = store.table(docs, f"free-{n}")
            shared.destroy()
    return docs


def _free(shared: Broadcast, name: str, q: int, rate: float):
    @F.pandas_udf(T.BooleanType())
    def free(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searcher, _ = _searcher(name, shared, q, rate)
        for s in texts:
            out = np.ones(len(s), bool)
            out[[d for d, *_ in _copies(searcher, s, False)]] = False
            yield pd.Series(out)

    return free
