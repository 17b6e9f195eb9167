"""Language identification: sparse multinomial logistic regression on character n-grams.

A text's letters, lower-cased, with one space for whatever stands between them,
give n-grams of 1 to 3 characters, which are hashed into ``BUCKETS``.  Their
logarithmic counts are weighted by how few documents have them (counted over
all documents that may be learned from) and brought to length 1.  A bounded
sample per language is learned with follow-the-regularised-leader, whose
elastic net keeps most weights at zero; one part of the sample isn't learned
but sets the temperature that makes the scores honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import held_out

BUCKETS, LONGEST = 1 << 16, 3
#: Documents that are learned per language, at most (those with the least hash of doc_id); every fifth sets the temperature.
SAMPLE, CALIBRATE = 600, 5
EPOCHS, RATE, SMOOTH, L1, L2 = 4, 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
_MIX = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@cache
def _letters() -> np.ndarray:
    """By code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets of the whole text's n-grams and their counts; None for a text without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes] if len(codes) else np.zeros(0, bool)
    if not letter.any():
        return None
    keep = letter | np.concatenate(([False], letter[:-1]))  # the first of the characters between two words stands for all
    if not letter[-1]:
        keep[np.flatnonzero(keep)[-1]] = False  # the text ends with one space, as it begins
    chars = np.concatenate(([32], np.where(letter, codes, 32)[keep], [32])).astype(np.uint32)
    out = []
    with np.errstate(over="ignore"):
        for n in range(1, LONGEST + 1):
            h = np.full(len(chars) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ chars[k : len(chars) - n + 1 + k]) * _MIX[k]
                h ^= h >> np.uint32(15)
            out.append(h & np.uint32(BUCKETS - 1))
    if n * len(chars) > BUCKETS // 4:
        counts = np.bincount(np.concatenate(out), minlength=BUCKETS)
        held = np.flatnonzero(counts)
        return held, counts[held]
    return np.unique(np.concatenate(out), return_counts=True)


class Model:
    """Weights by bucket and language, their idf, and a temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.langs, self.idf, self.weights, self.bias, self.temperature = langs, idf, weights, bias, temperature

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        held, counts = found
        x = np.log1p(counts) * self.idf[held]
        return held, x / np.sqrt(x @ x)

    def logits(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        held, x = self.vector(found)
        return x @ self.weights[held] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text)
        if found is None or not self.langs:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(found) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """A model from rows (language, buckets, counts), in the order in which they are learned; without rows it knows no language."""
    langs = sorted({r[0] for r in rows})
    model = Model(langs, idf, np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)))
    if len(langs) < 2:
        return model
    z, seen = np.zeros((BUCKETS + 1, len(langs))), np.zeros((BUCKETS + 1, len(langs)))

    def leader(at: np.ndarray) -> np.ndarray:
        """Follow-the-regularised-leader's weights for what was seen so far."""
        slack = np.maximum(np.abs(z[at]) - L1, 0)
        return -np.sign(z[at]) * slack / ((SMOOTH + np.sqrt(seen[at])) / RATE + L2)

    examples = [(langs.index(lang), *model.vector((held, counts))) for lang, held, counts in rows]
    aside = [e for k, e in enumerate(examples) if k % CALIBRATE == CALIBRATE - 1]
    learned = [e for k, e in enumerate(examples) if k % CALIBRATE != CALIBRATE - 1]
    for _ in range(EPOCHS):
        for lang, held, x in learned:
            at, x = np.append(held, BUCKETS), np.append(x, 1.0)  # the last entry is the bias
            w = leader(at)
            error = _softmax(x @ w)
            error[lang] -= 1
            g = x[:, None] * error
            square = seen[at] + g * g
            z[at] += g - (np.sqrt(square) - np.sqrt(seen[at])) / RATE * w
            seen[at] = square
    w = leader(np.arange(BUCKETS + 1))
    model.weights, model.bias = w[:-1].astype(np.float32), w[-1]
    if aside:
        logits = np.array([x @ model.weights[held] + model.bias for _, held, x in aside])
        own = np.array([e[0] for e in aside])

        doubt = len(langs) / (len(own) + len(langs) + 1.0)  # so that no finite set of right answers makes certain

        def loss(log_t: float) -> float:
            p = _softmax(logits / np.exp(log_t)) + 1e-12
            return -((1 - doubt) * np.log(p[np.arange(len(own)), own]) + doubt * np.log(p).mean(1)).mean()

        low, high, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
        for _ in range(60):
            a, b = high - golden * (high - low), low + golden * (high - low)
            low, high = (low, b) if loss(a) <= loss(b) else (a, high)
        model.temperature = float(np.exp((low + high) / 2))
    return model


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> by bucket, the documents of this task that have it; the last bucket counts all."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for batch in batches:
        for text in batch.column(0):
            found = grams(text.as_py())
            if found is not None:
                total[found[0]] += 1
                total[BUCKETS] += 1
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["bucket", "documents"])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t.as_py()) for t in batch.column(2)]
        empty = (np.zeros(0), np.zeros(0))
        columns = [pa.array([np.asarray((f or empty)[k], "<i4").tobytes() for f in found], pa.binary()) for k in range(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "lang", "held", "counts"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the documents that have a language and a doc_id and aren't held out: idf over all, weights from ``sample`` per language."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.select("text").mapInArrow(_counted, "bucket int, documents long").groupBy("bucket").agg(F.sum("documents").alias("documents")).collect()
    per = np.zeros(BUCKETS + 1)
    for bucket, documents in counts:
        per[bucket] = documents
    idf = np.log((1 + per[BUCKETS]) / (1 + per[:BUCKETS])) + 1
    # Which rows of a language are learned follows from a hash: a threshold leaves about twice as many as are wanted, so that none but these are ranked.
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    share = F.pmod(F.col("doc_id").bitwiseXOR(F.xxhash64("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row per language, each of which the model holds weights for
    if not sizes:
        return fit([], idf)
    size = F.try_element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], r["n"])]), F.col("lang"))
    likely = known.select("doc_id", "lang").where(share * size <= 2 * sample + 50).distinct()
    picked = likely.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_k") <= sample).drop("_k")
    own = known.join(F.broadcast(picked), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    measured = own.mapInArrow(_measured, "doc_id long, lang string, held binary, counts binary")
    rows = measured.groupBy("doc_id", "lang").agg(F.min(F.struct("held", "counts")).alias("x")).orderBy(*order, "lang").collect()
    arrays = [(r["lang"], np.frombuffer(r["x"]["held"], "<i4"), np.frombuffer(r["x"]["counts"], "<i4")) for r in rows]
    return fit([a for a in arrays if len(a[1])], idf)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs(doc_id, text, lang)`` -> a row for each row: doc_id, held_out, lang_pred, score.

    The whole text is the only input of a prediction, however long.  Texts that
    are null or have no letter are ``und`` with score 0, as are all where no
    language can be learned (no row with lang and doc_id outside the held-out
    part; a lone language has score 1).  Of equal scores the language first in
    order counts.  Repeated rows and doc_ids are predicted like any other (of one
    that is in the sample only one text is learned); no rows give no rows; other
    columns are ignored, whatever their names.
    """
    model = train(docs, sample)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())], ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(predict, "doc_id long, lang_pred string, score double").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
