"""Best-fit packing of documents into fixed-length sequences.

The plan is made on the histogram of piece lengths, which has at most
``capacity`` rows however many documents there are:

1. the configuration linear program (fewest sequences whose contents cover
   the histogram) is solved by multiplicative weights.  Each round prices the
   configurations by dynamic programming over the knapsack ``capacity``, for
   all lengths at once: the same table gives the dearest configuration and the
   dearest one that has a given length.  Any prices, divided by that of the
   dearest configuration, bound the program from below; rounds end once the
   fractional solution is within ``GAP`` of the best bound;
2. the fractional solution is rounded to whole sequences, and the program is
   solved again for what is left;
3. the rest is packed by best fit, a pattern at a time: longest piece first,
   then the longest that still fits, as often as the counts allow.  Of the
   plans that leave the program's rounding at different points, that without
   it included, the one with the fewest sequences is used.

Each document then finds its place from its rank among the pieces of its
length, so no task ever holds more than a share of the pieces.
"""

from __future__ import annotations

import math
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store, tokens

CAPACITY = 4096
END = 1
#: Rounds of multiplicative weights at most, each over all lengths, their first step and how it shrinks, what an earlier round counts for
#: in the solution, and the gap to the lower bound that ends them.
ROUNDS, ETA, SHRINK, DECAY, GAP = 30, 0.12, 0.96, 0.8, 0.003
#: Rounds without a better solution that end them as well.
PATIENCE = 6
#: How much cheaper than the dearest configuration one may be that is used in a round; tried in turn.
SLACKS = (0.002, 0.01)
#: Times the program is solved again for what rounding left, at most.
SOLVES = 3

Pattern = tuple[tuple[int, int], ...]


class Knapsack:
    """The dearest contents of each room up to ``capacity``, for prices by length (-inf: no such piece)."""

    def __init__(self, price: np.ndarray, capacity: int):
        self.price, self.best = price, np.zeros(capacity + 1)
        best, some = self.best, price[1:]
        for c in range(1, capacity + 1):
            best[c] = max(best[c - 1], (some[:c] + best[c - 1 :: -1][:c]).max())

    def contents(self, c: int, wanted: np.ndarray, slack: float) -> dict[int, int]:
        """Pieces for room ``c`` that are worth all but ``slack`` of the dearest, those that are most ``wanted`` first."""
        out: dict[int, int] = {}
        while c > 0 and self.best[c] > 0:
            lost = self.best[c] - (self.price[1 : c + 1] + self.best[c - 1 :: -1][:c])
            near = np.flatnonzero(lost <= slack + 1e-9)
            k = 1 + int(near[wanted[near + 1].argmax()]) if len(near) else 0
            if not k or (k in out and wanted[k] <= 0):
                k = 1 + int(lost.argmin())
            slack -= max(0.0, float(lost[k - 1]))
            out[k] = out.get(k, 0) + 1
            c -= k
            if self.best[c] <= slack:
                break
        return out


def solve(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, slack: float = SLACKS[0]) -> tuple[dict[Pattern, float], float]:
    """A fractional solution of the configuration program, ``{pattern: sequences}``, and a lower bound of the program.

    A round uses the dearest configurations to cover each length once, where it
    can; lengths that stay open become dearer, those covered twice cheaper.
    A solution is a mean over the rounds, in which the last ones count most; the
    one that needs the fewest sequences, its uncovered tokens included, is kept.
    """
    lengths = np.array(sorted(counts), np.int64)
    count = np.zeros(capacity + 1)
    count[lengths] = [counts[int(k)] for k in lengths]
    # The dual of a perfect packing prices a token alike wherever it is.
    weight, mean, used, covered, bound, eta = np.log(lengths), np.zeros(len(lengths)), {}, np.zeros(len(lengths)), 0.0, ETA
    best: tuple[float, dict[Pattern, float], int] = (math.inf, {}, 0)

    def priced(values: np.ndarray) -> tuple[np.ndarray, Knapsack]:
        nonlocal bound
        price = np.full(capacity + 1, -np.inf)
        price[lengths] = values
        sack = Knapsack(price, capacity)
        bound = max(bound, float((count[lengths] * values).sum() / sack.best[capacity]))
        return price, sack

    for t in range(rounds):
        price, sack = priced(np.exp(weight))
        mean = DECAY * mean + price[lengths] / sack.best[capacity]
        if t % 5 == 4:
            priced(mean)
        top, gain = sack.best[capacity], np.zeros(capacity + 1)
        worth = price[lengths] + sack.best[capacity - lengths]
        used = {p: DECAY * x for p, x in used.items() if x > 1e-9}
        for k in lengths[worth >= (1 - slack) * top][::-1].tolist():
            while gain[k] < 1 - 1e-6:
                wanted = (1 - gain) * count
                inside = sack.contents(capacity - k, wanted, float(price[k] + sack.best[capacity - k] - (1 - slack) * top))
                inside[k] = inside.get(k, 0) + 1
                # As far as the pieces go that are wanted; what only fills up may be covered more than once.
                most = wanted[k] / inside[k]
                amount = most if wanted[k] < 0.1 * count[k] else min(most, max(most / 3, min(wanted[j] / n for j, n in inside.items())))
                for j, n in inside.items():
                    gain[j] += n * amount / count[j]
                pattern = tuple(sorted(inside.items(), reverse=True))
                used[pattern] = used.get(pattern, 0.0) + amount
        covered = DECAY * covered + gain[lengths]
        weight += eta * np.clip(1 - gain[lengths], -2, 1)
        eta *= SHRINK
        scale = max(1e-9, float(np.median(covered)))
        rest = np.maximum(0, 1 - covered / scale) * count[lengths] * lengths
        needs = sum(used.values()) / scale + float(rest.sum()) / capacity
        if needs < best[0]:
            best = needs, {p: x / scale for p, x in used.items()}, t
        if needs <= (1 + GAP) * bound or t - best[2] >= PATIENCE:
            break
    return best[1], bound


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best fit over a histogram: ``(pattern, sequences)``."""
    left, open_, out = dict(counts), sorted(k for k, n in counts.items() if n), []
    while open_:
        room, pattern = capacity, {}
        while True:
            at = bisect_right(open_, room) - 1
            while at >= 0 and left[open_[at]] == pattern.get(open_[at], 0):
                at -= 1
            if at < 0:
                break
            k = open_[at]
            n = min(room // k, left[k] - pattern.get(k, 0))
            pattern[k] = pattern.get(k, 0) + n
            room -= n * k
        times = min(left[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= n * times
        out.append((tuple(pattern.items()), times))
        open_ = [k for k in open_ if left[k]]
    return out


def rounded(used: dict[Pattern, float], left: dict[int, int]) -> list[tuple[Pattern, int]]:
    """Whole sequences of a fractional solution, as far as ``left`` (which they are taken from) has the pieces.

    Whole parts first.  Where that is next to nothing, because lengths are many
    and pieces few, the largest fractions are rounded up, to half of them.
    """
    out: list[tuple[Pattern, int]] = []

    def take(pattern: Pattern, times: int) -> int:
        times = min(times, *(left[k] // n for k, n in pattern))
        if times > 0:
            for k, n in pattern:
                left[k] -= n * times
            out.append((pattern, times))
        return max(0, times)

    order = sorted(used, key=lambda p: (-used[p], p))
    whole, total = sum(take(p, int(used[p])) for p in order), sum(used.values())
    if whole < 0.2 * total:
        for p in order:
            whole += take(p, 1)
            if whole >= 0.5 * total:
                break
    return out


def _sequences(plan: list[tuple[Pattern, int]]) -> int:
    return sum(times for _, times in plan)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Pattern, int]]:
    """Patterns ``(((length, copies), ..), sequences)`` that hold exactly what ``histogram`` counts."""
    pieces = {int(k): int(n) for k, n in histogram.items() if n}
    full = [(((capacity, 1),), pieces.pop(capacity))] if capacity in pieces else []
    best, tokens_ = best_fit(pieces, capacity), sum(k * n for k, n in pieces.items())
    plans = [best]
    for slack in SLACKS if rounds else ():
        taken, left = [], dict(pieces)
        for _ in range(SOLVES):
            got = rounded(solve(left, capacity, rounds, slack)[0], left) if left else []
            if not got:
                break
            taken = taken + got
            left = {k: n for k, n in left.items() if n}
            plans.insert(0, taken + best_fit(left, capacity))
            best = min(plans, key=_sequences)  # of equals, that which the program made most of
            if _sequences(best) * capacity < tokens_ + capacity:  # no plan is better
                return full + best
    return full + best


def slots(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, copies in a sequence, first sequence, first offset), by rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranked: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for k, n in sorted(pattern, reverse=True):
            out.setdefault(k, []).append((ranked.get(k, 0), n, sequence, offset))
            ranked[k] = ranked.get(k, 0) + n * times
            offset += n * k
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """``docs(doc_id, text)`` -> ``part, doc_id, piece, start, length, ids_crc32``; only longer documents are cut."""
    last, spaced = struct.pack("<I", end), vocabulary.startswith("byte")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, encoder = TaskContext.get().partitionId(), None
        for f in frames:
            encoder = encoder or tokens.encoder(tokens.vocabulary(vocabulary), spaced)
            out = []
            for row, ids in enumerate(encoder.encode(list(f["text"]))):
                ids += last
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    out.append((row, i, at // 4, len(own) // 4, zlib.crc32(own)))
            rows, *rest = (np.array(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 5
            yield pd.DataFrame({"part": np.full(len(rows), part, np.int32), "doc_id": f["doc_id"].to_numpy()[rows]} | dict(zip(["piece", "start", "length", "ids_crc32"], rest)))

    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    raw = slim.mapInPandas(cut, "part int, doc_id string, piece int, start long, length long, ids_crc32 long")
    return raw.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end: int = END, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``docs(doc_id, text)`` -> per piece its place: ``sequence_id`` and ``offset``.

    A null or empty text is one piece with the end id alone; null doc_ids and
    repeated rows are packed like any other; no rows give no rows; other
    columns are ignored.
    """
    cut = store.table(pieces(docs, vocabulary, end, capacity), "pieces")
    # A row a length: never more than the capacity.
    histogram = {int(r["length"]): int(r["count"]) for r in cut.groupBy("length").count().collect()}
    table = slots(plan(histogram, capacity, rounds))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("part", "length").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).select("part", "length", "base")
    within = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = cut.withColumn("own", F.row_number().over(within) - 1).join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("own"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            order = np.argsort(f["length"].to_numpy(), kind="stable")
            f = f.iloc[order]
            length, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            sequence, offset = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            cuts = np.flatnonzero(np.diff(length, prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                rows = table[int(length[a])]
                row = rows[np.searchsorted(rows[:, 0], rank[a:b], "right") - 1]
                nth = rank[a:b] - row[:, 0]
                sequence[a:b] = row[:, 2] + nth // row[:, 1]
                offset[a:b] = row[:, 3] + nth % row[:, 1] * length[a]
            yield f.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    slim = ranked.select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32", "rank")
    out = slim.mapInPandas(place, "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
