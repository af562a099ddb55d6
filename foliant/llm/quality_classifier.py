"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, pairs of
neighbouring words, and character n-grams of 3 to 5 bytes inside words (A-Z
lower-cased). A pair that the document already had counts as one common feature,
so repetition is visible to a bag of features. A softmax layer turns the mean
into the score. Vectors and layer are trained by stochastic gradient descent in
numpy. With two classes the trained model gives the same scores as one number
for each bucket (its vector times the difference of the two output rows), and
that table is what is broadcast.

Defined results: a null or empty text scores by the output layer's intercept;
rows without id are scored and never held out; repeated rows are scored alike;
without any training row every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.labelled import remainder, sample, train_in_task
from foliant.llm.text import cut_words, fold_az, hash_spans, lanes, mix, small_batches, utf8, _SPACE

#: 2 ** BITS buckets of vectors; bounds the model.
BITS, DIM = 18, 12
#: Labelled rows to learn from, at most (chosen by hash of the id).
TRAIN_ROWS = 4000
EPOCHS, RATE = 6, 0.5
GRAMS = (3, 4, 5)
FOLDS, HELD_OUT = 4, 2
KEEP = 0.7


def _words(data: np.ndarray, offsets: np.ndarray, bits: int):
    """Buckets of words and pairs, and the row of each."""
    shift = np.uint64(64 - bits)
    starts, lengths, word_at = cut_words(data, offsets)
    h = hash_spans(data, starts, lengths)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(word_at))
    same = row[:-1] == row[1:]
    pair = mix(h[:-1][same] * np.uint64(5) + h[1:][same])
    pair_row = row[:-1][same]
    order = np.argsort(mix(pair + pair_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    seen = np.zeros(len(pair), bool)
    seen[order[1:]] = (pair[order[1:]] == pair[order[:-1]]) & (pair_row[order[1:]] == pair_row[order[:-1]])
    pair_bucket = np.where(seen, np.uint64(1), pair >> shift)
    return np.concatenate([h >> shift, pair_bucket]).astype(np.int32), np.concatenate([row, pair_row])


def _grams(data: np.ndarray, offsets: np.ndarray, bits: int):
    """For each n-gram length: which bytes start one inside a word, and its bucket."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    joined = np.zeros(len(data), bool)  # this byte and the next are of one word
    joined[:-1] = word[:-1] & word[1:] & ~edge[1:-1]
    view, valid, n = lanes(data), word, 1
    for size in GRAMS:
        while n < size:
            step = np.zeros(len(data), bool)
            step[: len(data) - n + 1] = joined[n - 1:]
            valid, n = valid & step, n + 1
        value = view[: len(data)] & np.uint64((1 << (8 * size)) - 1)
        bucket = (value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size * 0xD6E8FEB86659FD93 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        yield valid, (bucket >> np.uint64(64 - bits)).astype(np.int32)


def fit(texts: list[str], labels: list[int], bits: int = BITS, dim: int = DIM) -> bytes:
    """Train; the model is the intercept and one number for each bucket."""
    features = []
    for text in texts:
        data, offsets = utf8(pa.array([text], pa.string()))
        data = fold_az(data)
        own = [_words(data, offsets, bits)[0]] + [b[v] for v, b in _grams(data, offsets, bits)]
        bucket, count = np.unique(np.concatenate(own), return_counts=True)
        features.append((bucket.astype(np.int32), (count / max(count.sum(), 1)).astype(np.float32)))
    rng = np.random.default_rng(11)
    vectors = ((rng.random((1 << bits, dim), np.float32) - 0.5) / dim)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    step, steps = 0, EPOCHS * len(features)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(features)):
            bucket, share = features[k]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[bucket]
            mean = share @ own
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= rate * p
            # scaled by the number of features, as each share is that much smaller
            vectors[bucket] = own - np.minimum(rate * share * 50, rate)[:, None] * back
    weights = vectors @ (out[1] - out[0])
    return np.concatenate([[bias[1] - bias[0]], weights]).astype(np.float32).tobytes()


def scores(texts: pa.Array, bias: float, weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    data, offsets = utf8(texts)
    data = fold_az(data)
    rows = len(offsets) - 1
    bucket, row = _words(data, offsets, bits)
    total = np.bincount(row, weights[bucket], rows)
    count = np.bincount(row, minlength=rows).astype(np.float64)
    for valid, bucket in _grams(data, offsets, bits) if len(data) else ():
        value = np.where(valid, weights[bucket], np.float32(0))
        total += np.diff(np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])[offsets])
        count += np.diff(np.concatenate([[0], np.cumsum(valid)])[offsets])
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -35, 35)))


def quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, bits: int = BITS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``)."""
    small_batches(docs, 250)
    model = train_in_task(sample(docs, labels, "quality", FOLDS, HELD_OUT, train_rows), lambda t, y: fit(t, y, bits))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = np.frombuffer(shared.value, np.float32)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(batch.column(1), float(model[0]), model[1:], bits))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
