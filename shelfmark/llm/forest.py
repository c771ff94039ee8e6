"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

Every inner node of a tree cuts by the plane between two random rows of a sample, at the
median of the sample there. ``TREES`` trees are fitted on at most ``SAMPLE`` distinct
vectors per length, those of the smallest hashes (the bound of the fit); then **every**
row is sent down every tree into a leaf. A query walks all trees with one priority queue:
the waiting nodes of all trees, nearest first by the squared distances to the planes on
the far side of which they lie. It takes leaves until they hold ``SHARE`` times the rows
(over all trees, so a row may count several times), or until every waiting node lies beyond
a plane farther away than the ``k`` nearest rows of the sample, which loses nothing: on
clustered vectors that ends the search early, on vectors without structure hardly ever.
All rows of the leaves taken are scored exactly, in double precision on the vectors as
given. Nothing is capped: long leaves, and long lists of queries at a leaf, are cut into
blocks that meet block by block.

Rows of one vector are one *class*. Only classes are indexed and asked, with the smallest
``k`` + 1 ids of a class standing for it: no further id can be among the ``k`` nearest of
anything, as all its rows are equally near. So a vector that a third of the rows share
costs one entry, on the side of the rows and on the side of the queries.

Defined results: rows with a null id, a null, empty or zero vector or a null or non-finite
component take no part; vectors of different length are never compared (a length that the
sample does not have is one leaf, searched whole); an id that comes several times counts
once, with its best score, and is never its own candidate; equal scores take the smaller
id; with fewer than ``k`` candidates all found are returned; without rows there is no
result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import segments, settle, ship_package
from shelfmark.operators.lookup import lookup

K = 5
TREES, SAMPLE, SHARE = 4, 16_384, 1.2
#: Sample rows of a leaf at least, and the depth of a tree at most.
LEAF, DEPTH = 4, 8
#: Rows of a block of a leaf, and queries of a block.
BLOCK = 4096

CLASS = ["c1", "c2"]


class Tree:
    """A full binary tree as arrays: the plane of node ``i``; its children are 2i+1, 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int, random: np.random.Generator) -> None:
        self.depth = depth
        self.first_leaf = 2**depth - 1
        self.normals = np.zeros((self.first_leaf, sample.shape[1]))
        self.offsets = np.zeros(self.first_leaf)
        parts = {0: sample}
        for node in range(self.first_leaf):
            rows = parts.pop(node)
            low = high = rows
            if len(rows) > 1:
                a, b = rows[random.choice(len(rows), 2, replace=False)]
                normal = a - b
                size = np.sqrt(normal @ normal)
                if size > 0:
                    self.normals[node] = normal / size
                    side = rows @ self.normals[node]
                    self.offsets[node] = np.median(side)
                    low, high = rows[side <= self.offsets[node]], rows[side > self.offsets[node]]
                else:
                    high = rows[:0]
            parts[2 * node + 1], parts[2 * node + 2] = low, high

    def leaves(self, units: np.ndarray) -> np.ndarray:
        node = np.zeros(len(units), dtype=np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", units, self.normals[node]) - self.offsets[node]
            node = 2 * node + 1 + (side > 0)
        return node - self.first_leaf


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit_forest(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH, seed: int = 12) -> list[Tree]:
    """Trees over a sample of unit vectors, none where the sample is two leaves at most."""
    levels = min(depth, int(np.log2(max(len(sample) / leaf, 1))))
    random = np.random.default_rng(seed)
    return [Tree(sample, levels, random) for _ in range(trees)] if levels > 1 else []


def probes(
    forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, budget: float, reach: float = np.inf
) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs a query takes, nearest first, from one queue over all trees.

    Nodes beyond a plane at a distance of more than ``reach`` are never taken.
    """
    sides = [tree.normals @ query - tree.offsets for tree in forest]
    queue = [(0.0, number, 0) for number in range(len(forest))]
    taken: list[tuple[int, int]] = []
    held = 0
    while queue and held < budget:
        cost, number, node = heapq.heappop(queue)
        tree, side = forest[number], sides[number]
        while node < tree.first_leaf:
            # go on to the near child; the far one waits in the queue
            away = float(side[node])
            near, far = (2 * node + 2, 2 * node + 1) if away > 0 else (2 * node + 1, 2 * node + 2)
            if abs(away) <= reach:
                heapq.heappush(queue, (cost + away * away, number, far))
            node = near
        leaf = node - tree.first_leaf
        if sizes[number][leaf]:
            taken.append((number, leaf))
            held += int(sizes[number][leaf])
    return taken


def reaches(sample: np.ndarray, units: np.ndarray, k: int) -> np.ndarray:
    """For each unit vector a distance within which ``k`` others surely lie: its ``k`` + 1
    nearest of the sample, one of which it may be itself."""
    if len(sample) <= k:
        return np.full(len(units), np.inf)
    near = np.partition(units @ sample.T, len(sample) - k - 1, axis=1)[:, len(sample) - k - 1]
    return np.sqrt(np.maximum(2 - 2 * near, 0)) + 1e-6


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)


def _by_dim(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, int]]:
    for dim, part in batch.groupby("dim", sort=False):
        for start in range(0, len(part), 4096):
            yield part.iloc[start : start + 4096], int(dim)


def _routes(shared):
    """A row for each tree: the leaf it falls into."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, dim in _by_dim(batch):
                if dim not in shared.value:
                    yield part.assign(tree=0, leaf=0)
                    continue
                units = unit(_matrix(part["vec"]))
                for number, tree in enumerate(shared.value[dim][0]):
                    yield part.assign(tree=number, leaf=tree.leaves(units))

    return run


def _asked(shared, counted, share: float, k: int):
    """A row for each leaf that a query takes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, dim in _by_dim(batch):
                if dim not in shared.value:
                    yield part.assign(tree=0, leaf=0)
                    continue
                forest, sample = shared.value[dim]
                sizes, rows = counted.value[dim]
                for start in range(0, len(part), 64):
                    some = part.iloc[start : start + 64]
                    units = unit(_matrix(some["vec"]))
                    found = [probes(forest, sizes, u, share * rows, r) for u, r in zip(units, reaches(sample, units, k))]
                    out = some.loc[some.index.repeat([len(x) for x in found])]
                    pairs = np.array([p for x in found for p in x], dtype=np.int64).reshape(-1, 2)
                    yield out.assign(tree=pairs[:, 0], leaf=pairs[:, 1])

    return run


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b``; does not depend on the other rows."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        na, nb = _norms(a), _norms(b)
        score = (a * b).sum(axis=1) / (na * nb)
    odd = ~((np.minimum(na, nb) > 1e-140) & (np.maximum(na, nb) < 1e140))
    if odd.any():  # squares beyond a double: scale first
        x, y = (v[odd] / np.abs(v[odd]).max(axis=1, keepdims=True) for v in (a, b))
        score[odd] = (x * y).sum(axis=1) / (_norms(x) * _norms(y))
    return score


CELL = ["dim", "tree", "leaf", "block", "part"]


def _score(keep: int):
    """Per query of a leaf's block its ``keep`` nearest classes there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in segments(batches, CELL):
            for _, cell in group.groupby(CELL, sort=False):
                asks, rows = cell[cell["asks"]], cell[~cell["asks"]]
                if not len(asks) or not len(rows):
                    continue
                points, low = _matrix(rows["vec"]), rows["low"].to_numpy()
                units = unit(points).T
                ident = rows[CLASS].to_numpy()
                for start in range(0, len(asks), 256):
                    some = asks.iloc[start : start + 256]
                    queries = _matrix(some["vec"])
                    rough = unit(queries) @ units
                    least = np.partition(rough, -min(keep, len(low)), axis=1)[:, -min(keep, len(low))]
                    q, r = np.nonzero(rough >= least[:, None] - 1e-12)
                    score = exact_cosine(queries[q], points[r])
                    order = np.lexsort((low[r], -score, q))
                    q, r, score = q[order], r[order], score[order]
                    begin = np.searchsorted(q, q)
                    best = np.arange(len(q)) - begin < keep
                    q, r, score = q[best], r[best], score[best]
                    asked = some[CLASS].to_numpy()
                    yield pd.DataFrame(
                        {"q1": asked[q, 0], "q2": asked[q, 1], "c1": ident[r, 0], "c2": ident[r, 1], "low": low[r], "score": score}
                    )

    return run


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = K,
    trees: int = TREES,
    share: float = SHARE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` of the k nearest found per query.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = rows.sparkSession
    ship_package(spark)
    kind = dict(rows.select(F.col(vector).alias("v")).dtypes)["v"]
    kind = kind if kind == "array<float>" else "array<double>"
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0))
        .withColumns({"c1": F.xxhash64("vec"), "c2": F.xxhash64(F.lit(1), "vec")})
    )
    ids = settle(valid.select("vec_id", *CLASS).distinct(), "ids")
    first = F.row_number().over(Window.partitionBy(*CLASS).orderBy("vec_id"))
    members = ids.withColumn("n", first).where(F.col("n") <= k + 1).groupBy(*CLASS).agg(F.collect_list("vec_id").alias("ids"))
    classes = settle(
        valid.groupBy(*CLASS)
        .agg(F.first("vec").alias("vec"), F.min("vec_id").alias("low"))
        .withColumn("dim", F.size("vec").cast("long")),
        "classes",
    )
    by_dim = Window.partitionBy("dim").orderBy("c1", "c2")
    # rows of a rare length have a hash order of their own; all told within one bound
    chosen = classes.orderBy(*CLASS).limit(SAMPLE) if trees else classes.limit(0)
    sample = chosen.withColumn("n", F.row_number().over(by_dim)).toPandas()
    forests = {}
    for dim, part in sample.groupby("dim"):
        units = unit(_matrix(part.sort_values("n")["vec"]))
        fitted = fit_forest(units, trees)
        if fitted:
            forests[int(dim)] = fitted, units
    shared = spark.sparkContext.broadcast(forests)

    schema = f"c1 long, c2 long, vec {kind}, low long, dim long, tree long, leaf long"
    routed = classes.select(*CLASS, "vec", "low", "dim").mapInPandas(_routes(shared), schema)
    leaf = ["dim", "tree", "leaf"]
    sizes = settle(routed.groupBy(*leaf).agg(F.count("*").alias("rows")), "leaves")
    # at most trees * 2**DEPTH rows per length that the bounded sample has
    counted: dict[int, tuple[list[np.ndarray], int]] = {}
    for dim, (forest, _) in forests.items():
        counts = [np.zeros(2**tree.depth, dtype=np.int64) for tree in forest]
        for row in sizes.where(F.col("dim") == dim).collect():
            counts[row["tree"]][row["leaf"]] = row["rows"]
        counted[dim] = counts, int(counts[0].sum())
    askers = ids.where(is_query)
    asking = classes.join(askers.select(*CLASS).distinct(), CLASS, "left_semi").select(*CLASS, "vec", "low", "dim")
    asks = asking.mapInPandas(_asked(shared, spark.sparkContext.broadcast(counted), share, k), schema)

    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("long")
    asked = asks.groupBy(*leaf).agg(F.count("*").alias("queries"))
    cut = settle(
        sizes.join(asked, leaf).select(*leaf, blocks("rows").alias("blocks"), blocks("queries").alias("parts")), "cut"
    )
    own = F.xxhash64(*CLASS, F.lit(2))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    row_side = routed.join(cut, leaf).withColumn("block", F.pmod(own, F.col("blocks"))).withColumn("part", every("parts"))
    ask_side = asks.join(cut, leaf).withColumn("part", F.pmod(own, F.col("parts"))).withColumn("block", every("blocks"))
    columns = [*CELL, *CLASS, "low", "vec"]
    cells = row_side.select(*columns, F.lit(False).alias("asks")).union(ask_side.select(*columns, F.lit(True).alias("asks")))
    scored = (
        cells.repartition(*CELL)
        .sortWithinPartitions(*CELL)
        .mapInPandas(_score(k + 1), "q1 long, q2 long, c1 long, c2 long, low long, score double")
    )
    # of a class's ids only the smallest count, so the order by the smallest id is exact
    once = scored.groupBy("q1", "q2", *CLASS).agg(F.max("score").alias("score"), F.min("low").alias("low"))
    place = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "low"))
    near = settle(once.withColumn("place", place).where(F.col("place") <= k + 1).drop("place", "low"), "near")
    met = lookup(near, members, CLASS, "inner", "q1", rows_per_task=BLOCK)
    listed = (
        met.groupBy("q1", "q2")
        .agg(F.collect_list(F.struct((-F.col("score")).alias("d"), F.col("ids"))).alias("found"))
        .select(
            F.col("q1").alias("c1"),
            F.col("q2").alias("c2"),
            # the best score of an id counts: it is the first of its own in this order
            F.sort_array(F.flatten(F.transform("found", lambda x: F.transform(x["ids"], lambda i: F.struct(x["d"].alias("d"), i.alias("id")))))).alias("found"),
        )
    )
    answered = lookup(askers, listed, CLASS, "inner", "vec_id", rows_per_task=BLOCK)
    best = (
        answered.select(F.col("vec_id").alias("query_id"), F.explode("found").alias("f"))
        .where(F.col("f.id") != F.col("query_id"))
        .groupBy("query_id", F.col("f.id").alias("vec_id"))
        .agg(F.max(-F.col("f.d")).alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
