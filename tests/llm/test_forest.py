"""The forest search against brute force: recall on vectors without structure, exact scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import forest
from shelfmark.llm.queries import QUERIES


def _valid(rows):
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            yield i, np.array(v, dtype=np.float64)


def _brute(rows, k):
    out = {}
    rows = list(_valid(rows))
    for i, v in rows:
        if i % 50 == 0:
            best = out.setdefault(i, {})
            for j, w in rows:
                if j != i and len(v) == len(w):
                    score = float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())))
                    best[j] = max(best.get(j, -2.0), score)
    return {i: sorted(b.items(), key=lambda x: (-x[1], x[0]))[:k] for i, b in out.items() if b}


def _search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit(1)).withColumn("c1", F.lit("x"))
    found = {}
    for r in forest.nearest(df, F.col("vec_id") % 50 == 0, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def _recall(got, want):
    return sum(len({a for a, _ in got.get(q, [])} & {a for a, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_clusters_copies_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    v = centres[rng.integers(40, size=1500)] + 0.05 * rng.normal(size=(1500, 16))
    v[:500] = v[0]  # a third is one vector
    rows = [(int(i), [float(x) for x in x]) for i, x in enumerate(v)]
    rows += [(50, None), (51, [float("nan")] * 16), (52, [0.0] * 16), (53, [None] * 16), (54, []), (None, [1.0] * 16)]
    rows += [(5000, [1.0, 2.0]), (5050, [2.0, 4.0]), (5100, [1.0]), (100, rows[900][1]), rows[700], rows[700]]
    got, want = _search(spark, rows), _brute(rows, forest.K)
    assert got.keys() == want.keys()
    assert _recall(got, want) >= 0.99
    assert got[0] == want[0] and got[5050] == want[5050] and got[100] == want[100]
    assert 5100 not in got  # no other row of its length


def test_no_rows(spark):
    assert _search(spark, []) == {}
    assert _search(spark, [(50, [1.0, 0.0])]) == {}


def test_scaling_and_extreme_components(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1.0, 0.0]), (3, [-1.0, -1.0])]
    got = _search(spark, rows)[0]
    assert [i for i, _ in got] == [1, 2, 3]
    assert np.allclose([s for _, s in got], [1, np.sqrt(0.5), -1])


def test_search_ends_early_on_clusters_only():
    rng = np.random.default_rng(1)

    def share(points):
        units = forest.unit(points)
        trees = forest.fit_forest(units)
        leaves = [t.leaves(units) for t in trees]
        sizes = [np.bincount(x, minlength=2**t.depth) for x, t in zip(leaves, trees)]
        seen = []
        for i in range(0, len(units), 40):
            hit = np.zeros(len(units), dtype=bool)
            reach = forest.reaches(units, units[i : i + 1], 5)[0]
            for number, leaf in forest.probes(trees, sizes, units[i], forest.SHARE * len(units), reach):
                hit |= leaves[number] == leaf
            seen.append(hit.mean())
        return np.mean(seen)

    centres = rng.normal(size=(60, 32))
    assert share(centres[rng.integers(60, size=3000)] + 0.02 * rng.normal(size=(3000, 32))) < 0.3
    assert share(rng.normal(size=(3000, 32))) < 0.9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    want = _brute([(int(i), list(map(float, v))) for i, v in zip(frame["vec_id"], frame["embedding"])], 5)
    got = {}
    for r in QUERIES["op12_nearest"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert all(len(v) == 5 for v in got.values())
    assert _recall(got, want) >= 0.92
    scores = {(q, i): s for q, w in want.items() for i, s in w}
    assert all(scores.get((q, i), s) == s for q, found in got.items() for i, s in found)
