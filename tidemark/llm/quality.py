"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins; the model is a table of scores per
feature and per chosen pair of features.  The tables are learned by cyclic
boosting: in turn each feature gets a shallow tree on the current gradient, a
small step at a time, so no feature takes what another explains as well.
Pairs are ranked by what a four-cell cut gains on the residuals, then boosted
the same way.  A score is the sigmoid of the sum of one entry per table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kept

#: Labelled rows that are fitted, at most (those with the least hash of doc_id).
SAMPLE = 50_000
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST = 250, 120, 0.08, 20
THRESHOLD = 0.7
FEATURES = (
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "marks", "odd_marks", "spaces", "marked_words", "upper_words",
    "distinct_words", "distinct_lines", "distinct_pairs", "top_word", "line_words", "ended_lines", "one_mark_words", "long_words", "vowels",
)
_WORD, _ENDED = re.compile(r"\w+"), re.compile(r"[.!?…:;\"'»”)]\s*$")
_VOWELS = re.compile(r"[aeiouyáàâäãåéèêëíìîïóòôöõúùûüýæœø]", re.I)


def features(text: str | None) -> list[float]:
    """The features of one whole text; an empty one has zeros."""
    t = text or ""
    words = t.split()
    n, w = len(t), len(words)
    if not w:
        return [float(np.log1p(n))] + [0.0] * (len(FEATURES) - 1)
    codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
    low = codes < 128
    kinds = np.bincount(_KIND[np.where(low, codes, 128)], minlength=6) / n
    counts = Counter(words)
    lines = [x for x in (x.strip() for x in t.split("\n")) if x]
    pairs = set(zip(words, words[1:]))
    bare = sum(1 for x in words if x.isalnum())
    return [
        float(np.log1p(n)), float(np.log1p(w)), n / w, float(kinds[0] + kinds[1]), float(kinds[1]), float(kinds[2]), float(kinds[3]), float(kinds[4]), float(kinds[5]),
        1 - bare / w, sum(1 for x in words if x.isupper() and len(x) > 1) / w,
        len(counts) / w, len(set(lines)) / len(lines), (len(pairs) + 1) / w, max(counts.values()) / w, min(w / len(lines), 400.0),
        sum(1 for x in lines if _ENDED.search(x)) / len(lines), sum(k for x, k in counts.items() if len(x) == 1 and not x.isalnum()) / w,
        sum(k for x, k in counts.items() if len(x) > 18) / w, len(_VOWELS.findall(t)) / n,
    ]


def _kinds() -> np.ndarray:
    """Per ASCII code, and at 128 for all others: letter, capital, digit, common mark, other mark, space."""
    out = np.full(129, 4)
    for c in range(128):
        x = chr(c)
        out[c] = 1 if x.isupper() else 0 if x.islower() else 2 if x.isdigit() else 5 if x.isspace() else 3 if x in ".,;:!?'\"()-" else 4
    out[128] = 0
    return out


_KIND = _kinds()


def _tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Steps per bin of a tree with at most ``leaves`` leaves on ordered bins."""
    cuts = [(0, len(grad))]
    g, h, c = (np.concatenate(([0], np.cumsum(x))) for x in (grad, hess, count))
    value = lambda a, b: (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    while len(cuts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(cuts):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = worth(a, m) + worth(m, b) - worth(a, b)
            gain[(c[m] - c[a] < LEAST) | (c[b] - c[m] < LEAST)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), k, int(m[gain.argmax()]))
        if best[1] is None:
            break
        a, b = cuts[best[1]]
        cuts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in cuts:
        out[a:b] = value(a, b)
    return out


def _cells(x: np.ndarray) -> np.ndarray:
    """Sums over the four parts of a table, for each cut of both its sides: (below/above, below/above, cut, cut)."""
    s = np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    a, b = s[1:-1, 1:-1], s[1:-1, -1:]
    d, all_ = s[-1:, 1:-1], s[-1, -1]
    return np.stack([np.stack([a, b - a]), np.stack([d - a, all_ - b - d + a])])


def _quarters(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best cut of a two-way table into four parts."""
    if min(grad.shape) < 2:
        return 0.0, np.zeros_like(grad)
    g, h, c = _cells(grad), _cells(hess), _cells(count)
    gain = (g**2 / (h + 1.0)).sum((0, 1)) - grad.sum() ** 2 / (hess.sum() + 1.0)
    gain[(c < LEAST / 2).any((0, 1))] = 0
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.zeros_like(grad)
    if gain[i, j] > 1e-9:
        v = g[:, :, i, j] / (h[:, :, i, j] + 1.0)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v[0, 0], v[0, 1], v[1, 0], v[1, 1]
    return float(gain[i, j]), out


class Model:
    """``edges[f]``: inner edges of a feature's bins; ``tables[f]``; ``pairs``: (f, g, their coarser edges, table)."""

    def __init__(self, base: float, edges: list[np.ndarray], tables: list[np.ndarray], pairs: list[tuple]):
        self.base, self.edges, self.tables, self.pairs = base, edges, tables, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1 of the rows of ``x``; unknown values count as zero."""
        x = np.nan_to_num(x)
        out = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, f], "right")]
        for f, g, ef, eg, t in self.pairs:
            out += t[np.searchsorted(ef, x[:, f], "right"), np.searchsorted(eg, x[:, g], "right")]
        return 1 / (1 + np.exp(-out))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of ``y`` (0 or 1); one class alone, or no rows, gives a constant score."""
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Model(base, [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [])
    x = np.nan_to_num(x)
    edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    total = np.full(n, base)
    for _ in range(ROUNDS):
        for b, t, c in zip(bins, tables, counts):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _tree(np.bincount(b, y - p, len(t)), np.bincount(b, p * (1 - p), len(t)), c)
            t += step
            total += step[b]
    coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]

    def table(f: int, g: int, v: np.ndarray | None) -> np.ndarray:
        shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
        return np.bincount(cells[f] * shape[1] + cells[g], v, shape[0] * shape[1]).reshape(shape).astype(float)

    p = 1 / (1 + np.exp(-total))
    ranked = sorted(((_quarters(table(f, g, y - p), table(f, g, p * (1 - p)), table(f, g, None))[0], f, g) for f in range(x.shape[1]) for g in range(f)), reverse=True)
    pairs = [(f, g, coarse[f], coarse[g], np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1))) for gain, f, g in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for f, g, _, _, t in pairs:
            p = 1 / (1 + np.exp(-total))
            step = RATE * _quarters(table(f, g, y - p), table(f, g, p * (1 - p)), table(f, g, None))[1]
            t += step
            total += step[cells[f], cells[g]]
    return Model(base, edges, tables, pairs)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of ``docs`` that aren't held out, ``sample`` of them at most."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept.of("quality")
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "x": [features(t) for t in f["text"]], "y": f["y"]})

    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.round(F.avg("quality")).cast("int").alias("y"))
    picked = known.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(sample)
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(picked), "id")
    rows = own.mapInPandas(measure, "id long, x array<double>, y int").orderBy(F.xxhash64("id"), "id", "x").limit(sample).collect()
    return fit(np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES)), np.array([r["y"] for r in rows], float))


def scores(model: Model, text: str = "text") -> F.Column:
    """The model's score of a text column."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept.of("quality")
        for s in texts:
            yield pd.Series(model.score(np.array([features(t) for t in s], float).reshape(-1, len(FEATURES))))

    return score(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)``, ``labels(doc_id, quality)`` -> a row for each row: doc_id, held_out, score, predicted.

    Only features of the text are inputs.  Labels that are null or neither 0
    nor 1 are left out; several labels of one document count as their rounded
    mean.  Null and empty texts are scored like any other, and a text of any
    length by all of it; repeated rows are scored alike; without usable labels
    every score is 0.5; no rows give no rows; other columns are ignored.
    """
    scored = docs.select("doc_id", scores(train(docs, labels, sample)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` predicts to be good, all columns as they are."""
    return docs.where(scores(train(docs, labels, sample)) >= threshold)
