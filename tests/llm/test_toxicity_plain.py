"""The toxicity classifier against n-grams counted one by one and the optimum it must reach."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import toxicity


def bucket(gram):
    h = len(gram)
    for k, c in enumerate(gram):
        h = (h ^ (ord(c) * toxicity._MULTIPLIERS[k] & 0xFFFFFFFF)) * 0x01000193 & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - toxicity.BITS)


def features(text):
    """Features of a text: a bucket, once per level that its occurrences exceed."""
    padded = f" {text.lower()} " if text else ""
    times = Counter(bucket(padded[i : i + n]) for n in toxicity.SIZES for i in range(len(padded) - n + 1))
    return {k << toxicity.BITS | b for b, t in times.items() for k in range(toxicity.LEVELS) if t > k}


def test_fit_and_scores_against_plain_counts(spark):
    draw = random.Random(4)
    tame, rude = "river stone calm garden light wood table".split(), "vile rotten scum filth".split()
    texts, labels = [], []
    for i in range(80):
        words = draw.choices(tame, k=12)
        if i % 3 == 0:
            words[3:5] = draw.choices(rude, k=2)
        texts.append(" ".join(words).title() if i % 5 else " ".join(words))
        labels.append(int(i % 3 == 0))
    texts[7], labels[7] = "", 0
    docs = spark.createDataFrame(list(enumerate(texts)) + [(900, None), (901, "é" * 9)], "doc_id long, text string")
    told = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, told, F.col("doc_id") < 60)

    train = [features(t) for t in texts[:60]]
    y = np.array(labels[:60], dtype=float)
    seen = [Counter(f for fs, label in zip(train, y) if label == c for f in fs) for c in (0, 1)]
    size = [int((y == c).sum()) for c in (0, 1)]
    ratio = {
        f: math.log((seen[1][f] + 1) / (size[1] + 2)) - math.log((seen[0][f] + 1) / (size[0] + 2))
        for f in seen[0] | seen[1]
        if seen[0][f] + seen[1][f] >= toxicity.MIN_TEXTS
    }
    used = sorted(f for f, r in ratio.items() if abs(r) >= toxicity.MIN_RATIO)
    assert used and set(np.flatnonzero(model.weights)) <= set(used)

    # at the minimum of the mean log loss and the ridge term the gradient vanishes
    x = np.array([[ratio[f] if f in fs else 0.0 for f in used] for fs in train])
    w = np.array([model.weights[f] / ratio[f] for f in used])
    error = 1 / (1 + np.exp(-(x @ w + model.intercept))) - y
    start = np.abs(x.T @ (y.mean() - y)).max() / len(y)
    assert np.abs(x.T @ error / len(y) + toxicity.RIDGE * w).max() < 0.01 * start
    assert abs(error.mean()) < 0.01

    got = {r.doc_id: r.score for r in toxicity.with_toxicity(docs, model).collect()}
    for doc_id, text in [*enumerate(texts), (900, None), (901, "é" * 9)]:
        z = model.intercept + sum(model.weights[f] for f in features(text))
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-z)))
    assert all((got[i] >= 0.5) == bool(labels[i]) for i in range(60, 80))


def test_driver_memory_of_the_fit(spark):
    """The driver holds packed features, and a round of the fit works on a block of them."""
    draw = np.random.default_rng(5)
    words = [["".join(draw.choice(list("abcdefghijklmnop"), 7)) for _ in range(1000)] for _ in range(2)]
    texts = [" ".join(draw.choice(words[i % 2], 400)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, toxic int")
    tracemalloc.start()
    try:
        model = toxicity.fit_toxicity(docs, labels, F.lit(True))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert np.count_nonzero(model.weights) > 20_000
    assert peak < 35
