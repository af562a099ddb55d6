"""The trainers of toxicity and quality against plain loops on a few rows."""

import math
import random

import numpy as np
import pyarrow as pa

from foliant.llm import quality_classifier as Q
from foliant.llm import toxicity as T

BITS = 9


def texts_and_labels(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 30))) for _ in range(40)] + ["", "idiot!", "a"]
    return texts, [int("w3 " in t or "idiot" in t) for t in texts]


def test_ftrl_equals_plain_loops():
    texts, labels = texts_and_labels(1)
    features = []
    for t in texts:
        words = [w for w in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()]
        bucket, row = T.buckets(pa.array([t]), BITS)
        assert len(bucket) == len(words) + max(len(words) - 1, 0) + max(len(words) - 2, 0) and not row.any()
        features.append(sorted(set(bucket.tolist())) + ["bias"])
    n, z = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= T.L1:
            return 0.0
        return -(zi - math.copysign(T.L1, zi)) / ((T.BETA + math.sqrt(n.get(i, 0.0))) / T.ALPHA + T.L2)

    order = np.random.default_rng(7)
    for _ in range(T.EPOCHS):
        for k in order.permutation(len(texts)):
            w = {i: weight(i) for i in features[k]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[k]
            for i in features[k]:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / T.ALPHA * w[i]
                n[i] = old + g * g
    bias, weights = T.model_of(T.fit(texts, labels, BITS), BITS)
    assert abs(bias - weight("bias")) < 1e-9
    assert all(abs(weights[i] - weight(i)) < 1e-9 for i in range(1 << BITS))
    assert 0 < np.count_nonzero(weights) < 1 << BITS
    want = [1 / (1 + math.exp(-(weight("bias") + sum(weight(i) for i in f if i != "bias")))) for f in features]
    assert np.allclose(T.scores(pa.array(texts), bias, weights, BITS), want, atol=1e-9)


def test_embedding_sgd_equals_plain_loops():
    texts, labels = texts_and_labels(2)
    dim = 4
    features = []
    for t in texts:
        data, offsets = Q.utf8(pa.array([t]))
        data = Q.fold_az(data)
        found = Q._words(data, offsets, BITS)[0].tolist()
        for valid, bucket in Q._grams(data, offsets, BITS) if len(data) else ():
            found += bucket[valid].tolist()
        words = t.lower().split()
        assert len(found) == len(words) + max(len(words) - 1, 0) + sum(max(len(w) - g + 1, 0) for w in words for g in Q.GRAMS)
        features.append({b: found.count(b) / len(found) for b in sorted(set(found))})
    rng = np.random.default_rng(11)
    vectors = [[float(x) for x in row] for row in (rng.random((1 << BITS, dim), np.float32) - 0.5) / dim]
    out, bias = [[0.0] * dim, [0.0] * dim], [0.0, 0.0]
    step, steps = 0, Q.EPOCHS * len(texts)
    for _ in range(Q.EPOCHS):
        for k in rng.permutation(len(texts)):
            rate = Q.RATE * (1 - step / steps)
            step += 1
            mean = [sum(s * vectors[b][d] for b, s in features[k].items()) for d in range(dim)]
            logits = [sum(o * m for o, m in zip(out[c], mean)) + bias[c] for c in (0, 1)]
            p = [math.exp(x - max(logits)) for x in logits]
            p = [x / sum(p) for x in p]
            p[labels[k]] -= 1
            back = [p[0] * out[0][d] + p[1] * out[1][d] for d in range(dim)]
            for c in (0, 1):
                bias[c] -= rate * p[c]
                for d in range(dim):
                    out[c][d] -= rate * p[c] * mean[d]
            for b, s in features[k].items():
                for d in range(dim):
                    vectors[b][d] -= min(rate * s * 50, rate) * back[d]
    model = np.frombuffer(Q.fit(texts, labels, BITS, dim), np.float32)
    weights = [sum(v * (out[1][d] - out[0][d]) for d, v in enumerate(vectors[b])) for b in range(1 << BITS)]
    assert abs(model[0] - (bias[1] - bias[0])) < 1e-3 and np.allclose(model[1:], weights, atol=1e-3)
    want = [1 / (1 + math.exp(-(sum(s * weights[b] for b, s in f.items()) + bias[1] - bias[0]))) for f in features]
    assert np.allclose(Q.scores(pa.array(texts), float(model[0]), model[1:], BITS), want, atol=1e-3)
