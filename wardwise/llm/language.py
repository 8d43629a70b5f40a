"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams of one to four code points of the lower-cased text, hashed to buckets, weighted by
(1 + log tf) * idf and scaled to length 1. Document frequencies are counted over all learning documents.
The weights come from follow-the-regularised-leader steps (one rate per coordinate, L1 and L2 penalties) over at
most BOUND distinct labelled texts, as many of each language as of another, drawn by hash. A fifth of
them takes no steps; it fits the temperature by which the scores are divided before the softmax.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardwise.llm import words as W
from wardwise.session import Temporary, materialize

#: Labelled texts that the fit reads, over all languages; each language has at least one.
BOUND = 8_000
ORDERS = 4
MOST_BITS, WEIGHTS = 16, 1 << 23
EPOCHS, ALPHA, BETA, L1, L2 = 2, 1.0, 1.0, 0.05, 0.01
CALIBRATION = 5
#: Code points hashed at a time; longer texts go in pieces that overlap.
PIECE = 1 << 18
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
UNKNOWN = "und"


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, ascending; how often each occurs) of a whole text's n-grams."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total, few = None, []
    for lo in range(0, points.size, PIECE):
        piece = points[lo:lo + PIECE + ORDERS - 1].astype(np.uint64)
        own = min(PIECE, points.size - lo)  # n-grams that start here
        h, found = np.zeros(piece.size, np.uint64), []
        for n in range(1, ORDERS + 1):
            size = piece.size - n + 1
            if size <= 0:
                break
            h = h[:size] * _ODD[0] + piece[n - 1:] * _ODD[n - 1] + _ODD[3]
            found.append((h[:own] ^ (h[:own] >> np.uint64(29))) * _ODD[1] >> np.uint64(64 - bits))
        grams = np.concatenate(found).astype(np.int64)
        if points.size <= 1024:
            few.append(grams)
        else:
            counts = np.bincount(grams, minlength=1 << bits)
            total = counts if total is None else total + counts
    if total is not None:
        at = np.flatnonzero(total)
        return at, total[at]
    if not few:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(few), return_counts=True)


def vector(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights of length 1) of a text."""
    at, n = features(text, bits)
    x = (1 + np.log(n)) * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm > 0 else x


def _frequencies(bits: int):
    """Documents with each bucket, a row per bucket that a task has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                if has_letter(text):
                    seen[features(text, bits)[0]] += 1
                    docs += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], docs))], ["bucket", "n"])

    return run


class Ftrl:
    """Multinomial logistic regression by follow-the-regularised-leader; one row of state per bucket."""

    def __init__(self, bits: int, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        # the last row is the intercept, which is not penalised
        self.z, self.n = np.zeros(((1 << bits) + 1, classes)), np.zeros(((1 << bits) + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        kept = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -kept / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def intercept(self) -> np.ndarray:
        return -self.z[-1] * self.alpha / (self.beta + np.sqrt(self.n[-1]))

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.intercept()
        error = softmax(x @ w + b)
        error[label] -= 1
        for rows, grad, now in ((at, x[:, None] * error, w), (-1, error, b)):
            n = self.n[rows]
            more = n + grad * grad
            self.z[rows] += grad - (np.sqrt(more) - np.sqrt(n)) / self.alpha * now
            self.n[rows] = more

    def matrix(self) -> np.ndarray:
        """Weights of all buckets and, last, the intercept."""
        out = self.weights(slice(None))
        out[-1] = self.intercept()
        return out.astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm; 1 without rows."""
    if not labels.size:
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(labels.size), labels]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    lo, hi, golden = -5.0, 5.0, (np.sqrt(5) - 1) / 2
    a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
    fa, fb = loss(a), loss(b)
    for _ in range(40):
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - golden * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + golden * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    """`weights` has a row per bucket and, last, the intercept; a column per language."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int

    def probabilities(self, text: str) -> np.ndarray:
        at, x = vector(text, self.idf, self.bits)
        return softmax((x @ self.weights[at] + self.weights[-1]) / self.temperature)


def _fit(sent, classes: int, bits: int):
    """Steps over the rows in order, then the temperature from those that took none; one text is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, ftrl = sent.value, Ftrl(bits, classes)
        final, logits, labels = None, [], []
        for batch in batches:
            for epoch, label, text in zip(*(batch.column(c) for c in ("epoch", "label", "text"))):
                at, x = vector(text.as_py(), idf, bits)
                if epoch.as_py() < EPOCHS:
                    ftrl.step(at, x, label.as_py())
                else:
                    final = ftrl.matrix() if final is None else final
                    logits.append(x @ final[at] + final[-1])
                    labels.append(label.as_py())
        final = ftrl.matrix() if final is None else final
        heat = temperature(np.array(logits), np.array(labels, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([final.tobytes()], pa.binary()), pa.array([heat])], ["weights", "temperature"])

    return run


def train(docs: DataFrame, bound: int = BOUND) -> Model | None:
    """A model of docs (text, lang), of which all are learning documents; None where no text with a
    letter has a lang. Counts are over all of them, steps over at most `bound` (or one per language)."""
    spark = docs.sparkSession
    labelled = docs.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).select("text", "lang")
    key = F.xxhash64("text")
    # equal texts count once, so that no group of copies fills the sample
    distinct = materialize(labelled.groupBy("lang", key.alias("key")).count().select("lang", "key"), "labelled")
    langs = [r[0] for r in distinct.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return None
    bits = MOST_BITS
    while len(langs) << bits > WEIGHTS and bits > 8:
        bits -= 1
    each = max(1, bound // len(langs))
    # of a language of many texts about twice as many are ranked, by hash
    order = F.shiftrightunsigned(F.xxhash64("key", F.lit(3)), 12)
    sizes = materialize(distinct.groupBy(F.col("lang").alias("_of")).count(), "sizes")
    few = distinct.join(F.broadcast(sizes), F.col("lang") == F.col("_of")).where(
        order.cast("double") * F.col("count") <= float((2 * each + 64) << 52)).select("lang", "key")
    drawn = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(order, "key"))).where(F.col("place") <= each)
    numbers = spark.createDataFrame(list(zip(langs, range(len(langs)))), "_lang string, label int")
    drawn = materialize(drawn.join(F.broadcast(numbers), F.col("lang") == F.col("_lang")).select(
        F.col("key").alias("_key"), F.col("lang").alias("_lang"), "label", "place"), "drawn")

    counted = docs.select("text").mapInArrow(_frequencies(bits), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = dict(zip(counted["bucket"].to_pylist(), counted["n"].to_pylist()))
    n_docs, known = seen.pop(-1, 0), np.zeros(1 << bits)
    if seen:
        known[list(seen)] = list(seen.values())
    idf = np.log((n_docs + 1) / (known + 1)) + 1

    # at most `bound` texts, or one a language; one of each
    chosen = labelled.join(F.broadcast(drawn), (F.col("lang") == F.col("_lang")) & (key == F.col("_key")))
    chosen = materialize(chosen.groupBy("label", "place").agg(F.min("text").alias("text")), "sample")
    calibrates = F.col("place") % CALIBRATION == 0
    epochs = F.when(calibrates, F.array(F.lit(EPOCHS))).otherwise(F.array(*map(F.lit, range(EPOCHS))))
    # in order of epoch, then of the place in each language, so that languages take turns
    turns = chosen.select(F.explode(epochs).alias("epoch"), "label", "text", "place").coalesce(1).sortWithinPartitions("epoch", "place", "label")
    row = turns.mapInArrow(_fit(spark.sparkContext.broadcast(idf), len(langs), bits), "weights binary, temperature double").first()
    weights = np.frombuffer(row.weights, np.float32).reshape(-1, len(langs))
    return Model(langs, idf, weights, row.temperature, bits)


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                text = text.as_py()
                if model is None or not has_letter(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(text)
                best = int(p.argmax())
                langs.append(model.langs[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score per row of docs (doc_id, text); texts that are null or have no letter, and all
    without a model, are `und` with score 0. Ties go to the language that sorts first."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict(sent), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, bound: int = BOUND) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs (doc_id, text, lang), one row per row.

    Learns from documents that are not held out; a null doc_id is not held out. A null lang is learned from by
    document frequencies only. Repeated rows count as often as they stand, but are one text in the sample.
    An empty lang is a lang. Whole texts are read, the longest in pieces.
    """
    with Temporary(docs.sparkSession) as tables:
        model = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"), bound)
        found = predict(docs, model)
        return tables.keep(found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"), "languages")
