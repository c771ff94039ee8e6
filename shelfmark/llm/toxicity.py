"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, one linear model.

Every n-gram of the lower-cased text falls into one of ``2**BITS`` hash buckets. A text
has a bucket's k-th feature if at least k of its n-grams fall into it, for k up to
``LEVELS``: words that others mention once, toxic texts repeat. On the training texts
Spark counts, for each feature, the toxic and the other texts that have it; the smoothed
log ratio of the two shares scales the binary feature, and a ridge logistic regression
learns one weight per scaled feature. A score is a sum over the features of the whole
text.

Defined results: a null text scores as an empty one, which has no n-gram and scores by
the intercept; repeated rows score alike; a null id is never held out nor trained on;
with no usable label every text scores 0.5. Other columns of the input are kept by
``with_toxicity``, unless one has the score's own name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shelfmark.llm.common import labelled_sample, pieces, ship_package
from shelfmark.llm.linear import fit_logistic, sigmoid

BITS = 18
SIZES = (4, 5, 6)
#: Occurrences in a text that are told apart.
LEVELS = 4
FEATURES = LEVELS << BITS
#: Labelled texts the model is fitted on at most.
MAX_TRAINING = 12_000
#: A feature is used from this many training texts on ...
MIN_TEXTS = 4
#: ... and from this absolute log-count ratio on.
MIN_RATIO = 1.0
RIDGE = 2e-4
PIECE = 400_000
#: Code points of the texts whose n-grams are held at a time, a longer text apart.
RUN = 2_000_000
#: Features of training texts that a round of the fit works on at a time.
BLOCK = 200_000

#: Odd multiplier of the k-th character of an n-gram.
_MULTIPLIERS = [(0x9E3779B1 * (2 * k + 1)) % (1 << 32) | 1 for k in range(16)]


@dataclass(frozen=True)
class ToxicityModel:
    """One weight per feature (zero: not used) and the intercept."""

    weights: np.ndarray
    intercept: float


def grams(texts: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of the n-grams, piece by piece, each occurrence once."""
    lowered = texts.map(lambda t: f" {t.lower()} " if t else "")
    overlap, last = max(SIZES) - 1, -1
    for points, owner in pieces(lowered, PIECE, overlap):
        # a piece that goes on with a text begins with code points of the one before
        goes_on, last = owner[0] == last, owner[-1]
        for size in SIZES:
            count = len(points) - size + 1
            if count <= 0:
                continue
            h = np.full(count, size, dtype=np.uint32)
            for k in range(size):
                h = (h ^ (points[k : k + count] * np.uint32(_MULTIPLIERS[k]))) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            inside = owner[:count] == owner[size - 1 :]
            if goes_on:
                inside[: overlap - size + 1] = False
            yield owner[:count][inside], (h[inside] >> np.uint32(32 - BITS)).astype(np.int64)


def active(texts: pd.Series, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) with ``used[feature]``, ordered.

    Feature ``k << BITS | bucket`` says that the text has the bucket more than k times.
    """
    wanted = used.reshape(LEVELS, -1).any(axis=0)
    run = np.cumsum([len(t) if t else 0 for t in texts]) // RUN
    starts = np.flatnonzero(np.diff(run, prepend=-1)) if len(texts) else []
    numbers, features = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for a, b in zip(starts, [*starts[1:], len(texts)]):
        number, feature = _active(texts.iloc[a:b], used, wanted)
        numbers.append(number + a)
        features.append(feature)
    return np.concatenate(numbers), np.concatenate(features)


def _active(texts: pd.Series, used: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts that fit together; ``wanted``: buckets with a used feature."""
    found, times = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for owner, bucket in grams(texts):
        keep = wanted[bucket]
        codes, n = np.unique((owner[keep].astype(np.int64) << BITS) | bucket[keep], return_counts=True)
        found.append(codes)
        times.append(n)
    codes, place = np.unique(np.concatenate(found), return_inverse=True)
    total = np.bincount(place, np.concatenate(times), minlength=len(codes))
    number, bucket = codes >> BITS, codes & ((1 << BITS) - 1)
    numbers, features = [], []
    for k in range(LEVELS):  # a text's occurrences come from all of its pieces
        often = total > k
        numbers.append(number[often])
        features.append(bucket[often] | (k << BITS))
    number, feature = np.concatenate(numbers), np.concatenate(features)
    kept = used[feature]
    number, feature = number[kept], feature[kept]
    order = np.lexsort((feature, number))
    return number[order], feature[order]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((2, FEATURES), dtype=np.int64)
    every = np.ones(FEATURES, dtype=bool)
    for batch in batches:
        for text, y in zip(batch["text"], batch["y"].astype(int)):
            total[y, active(pd.Series([text]), every)[1]] += 1
    seen = np.flatnonzero(total.any(axis=0))
    yield pd.DataFrame({"feature": seen, "neg": total[0][seen], "pos": total[1][seen]})


def _features(used):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number, feature = active(batch["text"], used.value)
            ends = np.searchsorted(number, np.arange(1, len(batch)))
            lists = [part.astype("<i4").tobytes() for part in np.split(feature, ends)] if len(batch) else []
            yield pd.DataFrame({"y": batch["y"].to_numpy(), "features": lists})

    return run


def _scales(others: int, toxic: int):
    """Packed per batch: the features that tell the classes apart, and their log ratios."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            neg, pos = batch["neg"].to_numpy(dtype=float), batch["pos"].to_numpy(dtype=float)
            ratio = np.log((pos + 1) / (toxic + 2)) - np.log((neg + 1) / (others + 2))
            keep = np.abs(ratio) >= MIN_RATIO
            features = batch["feature"].to_numpy()[keep].astype("<i4").tobytes()
            yield pd.DataFrame({"features": [features], "scales": [ratio[keep].astype("<f8").tobytes()]})

    return run


#: Of some texts that follow one another: the first one's number, how many they are, and for
#: each feature that one of them has, the text (from 0) and the feature's place among those used.
Block = tuple[int, int, np.ndarray, np.ndarray]


def _blocks(rows: list[Row], place: np.ndarray) -> Iterator[Block]:
    """The training texts in blocks of about ``BLOCK`` features; empties ``rows``."""
    start, total = 0, len(rows)
    rows.reverse()
    while rows:
        lists, size = [], 0
        while rows and size < BLOCK:
            lists.append(np.frombuffer(rows.pop()["features"], dtype="<i4"))
            size += len(lists[-1])
        owner = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
        yield start, len(lists), owner, place[np.concatenate(lists)]
        start += len(lists)
    assert start == total


def _fit(blocks: list[Block], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the scaled features and the intercept.

    A feature's value is its scale wherever a text has it, so blocks hold places only and
    what a round computes for each of them is held for one block at a time.
    """

    def forward(w: np.ndarray) -> np.ndarray:
        out, scaled = np.empty(len(y)), scale * w
        for start, count, owner, column in blocks:
            out[start : start + count] = np.bincount(owner, scaled[column], minlength=count)
        return out

    def backward(r: np.ndarray) -> np.ndarray:
        out = np.zeros(len(scale))
        for start, _, owner, column in blocks:
            out += np.bincount(column, r[start:][owner], minlength=len(scale))
        return out * scale

    square = scale * scale
    largest = max((float(np.bincount(owner, square[column], minlength=1).max()) for _, _, owner, column in blocks), default=0.0)
    return fit_logistic(forward, backward, y, len(scale), largest + 1.0, l2=RIDGE, rounds=400)


def fit_toxicity(docs: DataFrame, labels: DataFrame, training: Column, max_training: int = MAX_TRAINING) -> ToxicityModel:
    """Fit on ``labels.toxic`` of the rows that ``training`` (over labels) selects.

    What reaches the driver is bounded: the log ratio of each used feature, and for each of
    at most ``max_training`` texts the used features that it has, both as packed bytes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sample = labelled_sample(docs, labels, "toxic", training, max_training).select("text", "y").persist()
    sizes = sample.groupBy("y").count().collect()
    n = {int(r["y"]): r["count"] for r in sizes}
    packed = (
        sample.mapInPandas(_count, "feature long, neg long, pos long")
        .groupBy("feature")
        .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
        .where(F.col("neg") + F.col("pos") >= MIN_TEXTS)
        .mapInPandas(_scales(n.get(0, 0), n.get(1, 0)), "features binary, scales binary")
        .collect()
    )
    scale = np.zeros(FEATURES)
    for row in packed:
        scale[np.frombuffer(row["features"], dtype="<i4")] = np.frombuffer(row["scales"], dtype="<f8")
    del packed
    used = spark.sparkContext.broadcast(scale != 0)
    rows = sample.mapInPandas(_features(used), "y double, features binary").collect()
    sample.unpersist()
    used.destroy()
    features = np.flatnonzero(scale)
    place = np.full(FEATURES, -1, dtype=np.int32)
    place[features] = np.arange(len(features))
    y = np.array([row["y"] for row in rows], dtype=float)
    blocks = list(_blocks(rows, place))
    weights, intercept = _fit(blocks, y, scale[features].astype(np.float32))
    table = np.zeros(FEATURES, dtype=np.float64)
    table[features] = weights * scale[features]
    return ToxicityModel(table, intercept if len(y) else 0.0)


def with_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability that each whole text is toxic."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        weights, intercept = shared.value
        number, feature = active(texts, weights != 0)
        return pd.Series(sigmoid(np.bincount(number, weights[feature], minlength=len(texts)) + intercept))

    return docs.withColumn(score, toxicity(F.col(text).cast("string")))
