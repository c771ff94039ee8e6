"""Periodic runs of words: stretches that repeat themselves, found by minimizers of many scales.

A run is a stretch of consecutive words whose smallest period is ``q`` (words ``q`` apart
are the same), at least ``least_exponent`` periods and ``least_length`` words long, that no
neighbouring word extends with that period.

Periods from ``P`` up to 2 ``P`` - 1 are the business of one scale, ``P`` a power of two.
There a gram is 2 ``P`` words, at least a period, so inside a run equal grams stand exactly
a multiple of the period apart. The gram of the smallest value in each window of ``P``
grams is its minimizer. Windows a period apart inside a run see the same grams, so they
choose minimizers a period apart, and between these two no equal gram stands: every run
shows up as two neighbouring minimizers of one value at the distance of its period. Such
pairs are the seeds; there are no more of them than minimizers. A seed is extended to both
sides word by word, in strides that double. Grams are numbered exactly, a scale's from pairs
of the numbers of the scale before, so no chance of a hash is involved. Periods under
``SHORT`` are read directly: the words are compared with themselves at that lag.

A stretch found with a multiple of its smallest period is dropped, as the run of that
smallest period is found on its own scale (four periods and more of a multiple always hold
the smallest one too).

Texts are worked on whole, many short ones side by side in one array; a very long one has
an array of its own, about 100 bytes a word. No rows are exchanged between tasks.

Defined results: null, empty and blank texts have no words and no runs; a null id stays
null; repeated rows are repeated in the result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ship_package

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: Periods below are scanned directly; a power of two.
SHORT = 8
#: Words that are worked on side by side.
WORDS_AT_A_TIME = 400_000


def words_of(text: str | None) -> list[bytes]:
    """The runs of anything but ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _true_stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every window of ``width``, from block-wise running minima."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.int64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def minimizers(values: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the smallest of some window of ``width``."""
    if len(values) < width:
        return np.empty(0, dtype=np.int64)
    least = _window_minimum(values, width)
    # the windows around a place hold none of a greater minimum than its own value
    most = np.full(len(values) + width - 1, np.iinfo(np.int64).min)
    most[width - 1 : width - 1 + len(least)] = least
    reached = -_window_minimum(-np.maximum(most, np.iinfo(np.int64).min + 1), width)
    return np.flatnonzero(reached == values)


def _agreement(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, going by ``step``, equal the one ``lag`` further on."""
    count, stride, n = 0, 64, len(words)
    while True:
        if step > 0:
            lo, hi = at + count, min(at + count + stride, n - lag)
            same = words[lo:hi] == words[lo + lag : hi + lag] if hi > lo else np.empty(0, bool)
        else:
            lo, hi = max(at - count - stride + 1, 0), at - count + 1
            same = (words[lo:hi] == words[lo + lag : hi + lag])[::-1] if hi > lo else np.empty(0, bool)
        if not len(same):
            return count
        if not same.all():
            return count + int(same.argmin())
        count += len(same)
        stride *= 2


def _primitive(unit: np.ndarray) -> bool:
    """Whether the unit is not a repetition of a shorter one."""
    q, rest, factor = len(unit), len(unit), 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            p = q // factor
            if (unit[p:] == unit[:-p]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def find_runs(
    words: np.ndarray, ends: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in ``words``, numbers of words.

    Several texts may stand one after the other, each followed by a number that occurs
    nowhere else, at the places ``ends``. ``least_exponent`` is 4 or more.
    """
    if least_exponent < 4:
        raise ValueError("the scales need runs of four periods or more")
    found = []

    def keep(start: int, length: int, q: int) -> None:
        if length >= max(least_length, least_exponent * q) and _primitive(words[start : start + q]):
            found.append((start, length, q))

    for q in range(1, min(SHORT, len(words))):
        starts, stops = _true_stretches(words[:-q] == words[q:])
        long = stops - starts + q >= max(least_length, least_exponent * q)
        for a, b in zip(starts[long].tolist(), stops[long].tolist()):
            keep(a, b - a + q, q)

    begins = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - begins
    names, width = words, 1  # exact numbers of the grams of ``width`` words
    places = np.arange(len(words))
    scale = SHORT
    while len(sizes) and sizes.max() >= least_exponent * scale:
        # texts too short for this scale leave, the others close up; a gram that would
        # reach beyond its text meets an end and is alone
        stays = sizes >= least_exponent * scale
        if not stays.all():
            mask = np.repeat(stays, sizes + 1)
            names, places, sizes = names[mask], places[mask], sizes[stays]
        while width < 2 * scale:
            after = np.full(len(names), -1, dtype=np.int64)
            after[: len(names) - width] = names[width:]
            top = int(names.max()) + 2
            _, names = np.unique(names.astype(np.int64) * top + after, return_inverse=True)
            width *= 2
        mixed = ((names.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        chosen = minimizers(mixed, scale)
        order = np.lexsort((chosen, names[chosen]))
        at, name = chosen[order], names[chosen][order]
        gap = at[1:] - at[:-1]
        seed = (name[1:] == name[:-1]) & (gap >= scale) & (gap < 2 * scale)
        lags, spots = gap[seed], places[at[:-1][seed]]
        order = np.lexsort((spots, lags))
        done_lag, done_until = 0, -1
        for lag, spot in zip(lags[order].tolist(), spots[order].tolist()):
            if lag == done_lag and spot < done_until:
                continue  # inside the stretch of the seed before
            left = _agreement(words, spot - 1, lag, -1) if spot else 0
            right = _agreement(words, spot, lag, 1)
            done_lag, done_until = lag, spot + right
            keep(spot - left, left + right + lag, lag)
        scale *= 2
    return sorted(set(found), key=lambda run: (run[0], run[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, q in runs:
            change[start + q] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _runs_of_texts(texts: list[list[bytes]], least_length: int, least_exponent: int) -> list[list[tuple[int, int, int]]]:
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + 1) - 1
    flat = np.empty(int(sizes.sum()), dtype=object)
    flat[:] = [word for words in texts for word in words]
    codes, known = pd.factorize(flat)
    words = np.empty(len(flat) + len(texts), dtype=np.int64)
    inside = np.ones(len(words), dtype=bool)
    inside[ends] = False
    words[inside] = codes
    words[ends] = len(known) + np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    begins = ends - sizes
    for start, length, q in find_runs(words, ends, least_length, least_exponent):
        owner = int(np.searchsorted(ends, start))
        out[owner].append((start - int(begins[owner]), length, q))
    return out


def _find(least_length: int, least_exponent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, count, texts = 0, 0, []
            for number, text in enumerate([*batch["text"], None]):
                last = number == len(batch)
                if texts and (last or count >= WORDS_AT_A_TIME):
                    runs = _runs_of_texts(texts, least_length, least_exponent)
                    yield pd.DataFrame(
                        {
                            "doc_id": batch["doc_id"].iloc[first:number],
                            "n_words": [len(words) for words in texts],
                            "runs": [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs],
                            "collapsed": [_collapsed(words, found) for words, found in zip(texts, runs)],
                        }
                    )
                    first, count, texts = number, 0, []
                if not last:
                    texts.append(words_of(text))
                    count += len(texts[-1])

    return run


def periodic_runs(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period) and
    ``collapsed``: the words that no run holds beyond its first period, joined by a space."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInPandas(_find(least_length, least_exponent), schema)


def _more_periods(a: Column, b: Column) -> Column:
    """Order of runs: most periods first (as exact fractions), then start, then period."""
    left, right = a["length"] * b["period"], b["length"] * a["period"]
    return (
        F.when(left != right, F.when(left > right, -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    )


def run_report(found: DataFrame) -> DataFrame:
    """Numbers and digests of :func:`periodic_runs`: the run of most periods, and SHA-256 of
    all runs (a line ``start,length,period`` each) and of the collapsed text."""
    best = F.get(F.array_sort("runs", _more_periods), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
