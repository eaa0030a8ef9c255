"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Features are the hashes of word 1-grams and 2-grams, over the lower-cased words
and over their shapes (letters, capitals and digits each become one mark, runs
collapse), in 2^``bits`` slots; a slot's value is its count over the square root
of the number of features, so a text is a sparse vector of bounded length
whatever its size. Training reads a bounded sample of the labelled documents
(``train_rows``, those of smallest id hash, a documented parameter) in one pass
after the other through one task; the weights (a fixed size) are sent to all
tasks, which score whole texts as sparse dot products.

Defined results: null and empty texts have no features and get the bias alone.
Labels that are null or contradict each other for one doc_id are not learned.
A null doc_id is held out. Rows that repeat a doc_id are scored one by one.
With no usable label all scores are 0.5. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm import words as W

BITS = 20
TRAIN_ROWS = 8000
EPOCHS = 2
CUTOFF = 0.3
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    shape = _SHAPE[data]
    keep = np.ones(len(shape), dtype=bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    at = np.cumsum(keep)
    return W.hash_spans(shape[keep], at[starts] - 1, at[ends - 1])


def slots(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of a chunk's texts, grouped by text, and the number of each text's."""
    starts, ends, first = W.find_words(data, offsets)
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    parts, owners = [], []
    shift = np.uint64(64 - bits)
    for kind, h in enumerate((W.hash_spans(W.LOWER[data], starts, ends), _shapes(data, starts, ends))):
        for width in (1, 2):
            if len(h) >= width:
                grams = W.ngrams(h + np.uint64(kind), width)
                same = text[:len(grams)] == text[width - 1:]
                parts.append((grams[same] >> shift).astype(np.int64))
                owners.append(text[:len(grams)][same])
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(len(count), dtype=np.int64)
    flat, owner = np.concatenate(parts), np.concatenate(owners)
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(count))


class Ftrl:
    """Follow-the-regularised-leader (proximal) for logistic loss."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def held_out(parts: int, part: int):
    """Whether crc32 of doc_id, as text, leaves ``part`` modulo ``parts``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, train_rows: int = TRAIN_ROWS,
          epochs: int = EPOCHS) -> np.ndarray:
    """Weights (2^bits slots and the bias) from documents outside the holdout."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other") \
        .filter(~held_out(5, 0))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("doc_id", "quality")
    # one row of an id that repeats: the sample is bounded by rows, not by ids
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id") \
        .groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")) \
        .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), F.xxhash64("text")).select("text", "quality")

    def fit(batches):
        seen = []
        for chunk, data, offsets in W.chunks(batches):
            flat, count = slots(data, offsets, bits)
            at = np.concatenate([[0], np.cumsum(count)])
            for i, y in enumerate(chunk.column(1).to_pylist()):
                slot, times = np.unique(flat[at[i]:at[i + 1]], return_counts=True)
                seen.append((slot.astype(np.int32), (times / max(1, count[i]) ** 0.5).astype(np.float32), float(y)))
        model = Ftrl(1 << bits)
        for _ in range(epochs):
            for slot, x, y in seen:
                model.learn(np.append(slot, 1 << bits), np.append(x, 1.0), y)
        yield pa.record_batch({"weights": pa.array(
            [zlib.compress(model.weights().astype("<f4").tobytes(), 1)], pa.binary())})

    made = rows.mapInArrow(fit, "weights binary").first()
    if made is None:  # nothing to learn from
        return np.zeros((1 << bits) + 1, dtype="<f4")
    return np.frombuffer(zlib.decompress(made.weights), dtype="<f4")


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(zlib.compress(weights.astype("<f4").tobytes(), 1))

    def rate(batches):
        w = np.frombuffer(zlib.decompress(model.value), dtype="<f4").astype(np.float64)
        for rows, data, offsets in W.chunks(batches):
            flat, count = slots(data, offsets, bits)
            owner = np.repeat(np.arange(len(count)), count)
            total = np.bincount(owner, weights=w[flat], minlength=len(count)) / np.sqrt(np.maximum(count, 1))
            p = 1 / (1 + np.exp(-np.clip(total + w[-1], -35, 35)))
            yield pa.record_batch({"doc_id": rows.column(0), "held_out": rows.column(2), "score": pa.array(p),
                                   "predicted": pa.array((p >= cutoff).astype(np.int32))})

    return docs.select("doc_id", "text", held_out(5, 0).alias("held_out")).mapInArrow(
        rate, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
