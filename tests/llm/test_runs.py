"""Periodic runs against a scan of every lag."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from shelfmark.llm import runs
from shelfmark.llm.queries import QUERIES


def _brute(w, least=6, exponent=4):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, exponent * q):
                s = w[i : i + length]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _text(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        few = rng.choice([1, 2, 3, 50])
        unit = [rng.randrange(few) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 63, 64]))]
        words += (unit * 8)[: int(len(unit) * rng.uniform(0.5, 6)) + rng.randint(0, 3)]
    return [b"%d" % w for w in words]


def test_against_all_lags():
    rng = random.Random(7)
    for _ in range(150):
        texts = [_text(rng) for _ in range(rng.randint(1, 6))]
        assert runs._runs_of_texts(texts, 6, 4) == [_brute(t) for t in texts]


def test_minimizers_are_window_minima():
    rng = np.random.default_rng(3)
    for n, width in ((1, 1), (5, 8), (8, 8), (100, 8), (257, 16)):
        values = rng.integers(0, 30, n)
        want = {i + int(np.flatnonzero(values[i : i + width] == values[i : i + width].min())[k])
                for i in range(n - width + 1) for k in range((values[i : i + width] == values[i : i + width].min()).sum())}
        assert set(runs.minimizers(values, width).tolist()) == want


def test_long_text_is_searched_whole():
    rng = np.random.default_rng(5)
    unit = rng.integers(0, 10**6, 9000)
    words = [b"%d" % w for w in np.concatenate([rng.integers(0, 10**6, 50_000), np.tile(unit, 5)[:40_000], [1]])]
    (found,) = runs._runs_of_texts([words], 6, 4)
    assert found == [(50_000, 40_000, 9000)]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a " * 6), (5, "a b " * 4), (5, "a b " * 4), (6, "a a a a a a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("Collapsed", F.lit(1))
    got = sorted((tuple(r) for r in runs.periodic_runs(df).collect()), key=str)
    none = [(i, 0, [], "") for i in (1, 2, 3)]
    want = [*none, (None, 6, [(0, 6, 1)], "a"), *[(5, 8, [(0, 8, 2)], "a b")] * 2, (6, 5, [], "a a a a a a")]
    assert got == sorted(want, key=str)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def _sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _expected(doc_id, text):
    w = (text or "").encode("utf-8", "surrogatepass").split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _brute(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + length for s, length, q in found)]
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (doc_id, len(found), *best, milli, _sha(lines), _sha(b" ".join(kept).decode("utf-8", "surrogatepass")))


def test_query_against_all_lags(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    short = {r.doc_id for r in docs if len(r.text or "") < 20_000}  # the scan of all lags is quadratic
    want = sorted(_expected(r.doc_id, r.text) for r in docs if r.doc_id in short)
    got = QUERIES["op13_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect() if r.doc_id in short) == want
    assert sum(1 for row in want if row[1]) >= 5
