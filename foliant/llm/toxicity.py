"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, neighbouring pairs and pairs with one
word between of a text (A-Z lower-cased). FTRL-proximal keeps a learning rate
for each coordinate, and its L1 term leaves most weights at exactly zero, so the
model that is broadcast is a short list of (bucket, weight).

Defined results: a null or empty text scores by the intercept alone; rows without
id are scored and never held out; repeated rows are scored alike; without any
training row every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.labelled import remainder, sample, train_in_task
from foliant.llm.text import PUNCTUATION, cut_words, fold_az, hash_spans, mix, small_batches, utf8

#: 2 ** BITS buckets; bounds the model.
BITS = 20
#: Labelled rows to learn from, at most (chosen by hash of the id).
TRAIN_ROWS = 8000
EPOCHS, ALPHA, BETA, L1, L2 = 6, 2.0, 1.0, 8.0, 0.0
FOLDS, HELD_OUT = 5, 0


def buckets(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram and skip-gram of the rows, and its row."""
    data, offsets = utf8(texts)
    data = fold_az(data)
    starts, lengths, word_at = cut_words(data, offsets, PUNCTUATION)
    h = hash_spans(data, starts, lengths)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(word_at))
    parts, rows = [h], [row]
    for gap, salt in ((1, 2), (2, 3)):
        same = row[:-gap] == row[gap:] if len(row) > gap else np.zeros(0, bool)
        left = h[: len(same)][same]
        right = h[gap:][same] if len(same) else left
        parts.append(mix(left * np.uint64(2 * salt + 1) + right))
        rows.append(row[: len(same)][same])
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(rows)


def fit(texts: list[str], labels: list[int], bits: int = BITS) -> bytes:
    """Train; the model is the intercept, the bucket numbers and their weights."""
    n, z = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits
    features = []
    for at in range(0, len(texts), 256):
        bucket, row = buckets(pa.array(texts[at: at + 256], pa.string()), bits)
        ends = np.searchsorted(row[order := np.argsort(row, kind="stable")], np.arange(len(texts[at: at + 256]) + 1))
        bucket = bucket[order]
        features += [np.append(np.unique(bucket[a:b]), bias).astype(np.int32) for a, b in zip(ends[:-1], ends[1:])]

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(features)):
            i = features[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weights(np.arange(len(z)))
    kept = np.flatnonzero(w[:-1])
    return np.concatenate([[w[-1]], kept.astype(np.float64), w[kept]]).tobytes()


def model_of(stored: bytes, bits: int = BITS) -> tuple[float, np.ndarray]:
    numbers = np.frombuffer(stored, np.float64)
    weights = np.zeros(1 << bits)
    half = (len(numbers) - 1) // 2
    weights[numbers[1: half + 1].astype(np.int64)] = numbers[half + 1:]
    return float(numbers[0]), weights


def scores(texts: pa.Array, bias: float, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    bucket, row = buckets(texts, bits)
    used = np.flatnonzero(weights[bucket])
    pairs = np.unique((row[used].astype(np.uint64) << np.uint64(bits)) | bucket[used].astype(np.uint64))
    total = np.bincount((pairs >> np.uint64(bits)).astype(np.int64),
                        weights[(pairs & np.uint64((1 << bits) - 1)).astype(np.int64)], len(texts))
    return 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, bits: int = BITS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``)."""
    small_batches(docs, 250)
    model = train_in_task(sample(docs, labels, "toxic", FOLDS, HELD_OUT, train_rows), lambda t, y: fit(t, y, bits))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        bias, weights = model_of(shared.value, bits)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(batch.column(1), bias, weights, bits))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
