"""Exact top-k inner products by a dual-tree search over cover trees.

Vectors are sorted into cells around a few pivots, the roots of the data's cover trees,
and cells into blocks of bounded size; a task sweeps its blocks one after the other. For
every block it builds a whole cover tree: the children of a node lie within half its radius,
and their centres are further apart than that. Queries, in chunks of bounded size, travel
as a tree of the same kind. The pair of a query node and a data node is pruned when the
largest possible inner product, from centres and covering radii, stays under the worst
k-th score of the query node's queries; pairs of leaves are scored by matrix products.
The k-th scores start from the best of a bounded sample of rows and rise along the sweep,
so what leaves a task is at most k rows per query.

Defined results: rows with a null id, a null vector or a null or non-finite component
take no part; vectors of different length are never compared; an id that comes several
times counts once, with its best score, and is never its own candidate; equal scores
take the smaller id; without rows there is no result. Extra columns are ignored. Scores
are exact while they stay under 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import segments, settle, ship_package

K = 5
SCALE = 256
#: Rows of a block, queries of a chunk, rows that give the first k-th scores.
BLOCK, QUERIES, SEEDS = 4096, 8192, 2048
PIVOTS = 16
LEAF = 16
#: Children of a query node that are compared with those of a data node at a time.
WIDE = 256


class Node:
    """A ball: centre, covering radius, its rows, and its children, whose rows follow each other in ``rows``."""

    __slots__ = ("centre", "norm", "radius", "rows", "children", "starts", "sizes", "balls")

    def __init__(self, centre: np.ndarray, radius: float, rows: np.ndarray) -> None:
        self.centre, self.norm = centre, float(np.sqrt(centre @ centre))
        self.radius, self.rows = radius, rows
        self.children: list[Node] = []
        self._parts(np.zeros(1, dtype=np.int64), [self])

    def split(self, rows: np.ndarray, starts: np.ndarray, children: list[Node]) -> None:
        self.rows, self.children = rows, children
        self._parts(starts, children)

    def _parts(self, starts: np.ndarray, balls: list[Node]) -> None:
        """What is compared when the node is opened: its children, or itself if it is a leaf."""
        self.starts, self.sizes = starts, np.diff(starts, append=len(self.rows))
        self.balls = (
            np.array([c.centre for c in balls]),
            np.array([c.norm for c in balls]),
            np.array([c.radius for c in balls]),
        )


def _spread(local: np.ndarray, far: np.ndarray, first: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres, ``first`` among them, further apart than ``reach``, and each point's nearest one."""
    squares = np.einsum("ij,ij->i", local, local)
    nearest, owner, centres = far.copy(), np.zeros(len(local), dtype=np.int64), [first]
    while nearest[new := int(nearest.argmax())] > reach:
        gap = np.sqrt(np.maximum(squares + squares[new] - 2.0 * (local @ local[new]), 0.0))
        closer = gap < nearest
        closer[new], gap[new] = True, 0.0
        nearest[closer], owner[closer] = gap[closer], len(centres)
        centres.append(new)
    return np.array(centres), owner


def cover_tree(points: np.ndarray, rows: np.ndarray, centre: int) -> Node:
    """Tree over ``points[rows]`` around the point ``centre``, built without recursion.

    The centre of a node is the centre of one of its children (nesting), centres of
    siblings are further apart than half the node's radius (separation), and every row
    lies within that distance of its child's centre (covering). Nodes of up to ``LEAF``
    rows and of equal rows are leaves; all others are divided, however many children it
    takes. Each row becomes a new centre once at most, so n rows take n * n distances.
    """
    far = np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))
    root = Node(points[centre], float(far.max(initial=0.0)), rows)
    todo = [(root, centre, far)]
    while todo:
        node, centre, far = todo.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            continue
        local = points[node.rows]
        centres, owner = _spread(local, far, int(np.flatnonzero(node.rows == centre)[0]), node.radius / 2)
        order = np.argsort(owner, kind="stable")
        starts = np.searchsorted(owner[order], np.arange(len(centres)))
        # the radii come from plain differences, as those decide what is pruned
        inner = np.sqrt(((local[order] - local[centres[owner[order]]]) ** 2).sum(axis=1))
        heads, ordered, children = node.rows[centres], node.rows[order], []
        for head, low, high in zip(heads, starts, np.append(starts[1:], len(order))):
            child = Node(points[head], float(inner[low:high].max()), ordered[low:high])
            children.append(child)
            todo.append((child, int(head), inner[low:high]))
        node.split(ordered, starts, children)
    return root


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Row numbers of up to ``count`` points, each the farthest from those before."""
    chosen, gap = [], np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)) and (not chosen or gap.max() > 0):
        new = int(gap.argmax()) if chosen else 0
        chosen.append(new)
        gap = np.minimum(gap, ((points - points[new]) ** 2).sum(axis=1))
    return np.array(chosen, dtype=np.int64)


class Search:
    """The queries of one length, their tree and the best rows found so far.

    ``scored`` counts the pairs of rows that were scored, ``bounded`` the pairs of nodes
    whose bound was computed.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, floor: np.ndarray, k: int, tree: Node | None = None) -> None:
        self.ids, self.points, self.floor, self.k = ids, points, floor, k
        self.tree = tree or cover_tree(points, np.arange(len(ids)), 0)
        self.found: dict[int, dict[int, float]] = {}
        self.scored = self.bounded = 0

    def offer(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        self.scored += len(rows) * len(ids)
        scores = self.points[rows] @ points.T
        scores[self.ids[rows][:, None] == ids[None, :]] = -np.inf
        good = (scores >= self.floor[rows][:, None]) & (scores > -np.inf)
        for i in np.flatnonzero(good.any(axis=1)):
            row = int(rows[i])
            best = self.found.setdefault(row, {})
            for j in np.flatnonzero(good[i]):
                key = int(ids[j])
                best[key] = max(best.get(key, -np.inf), float(scores[i, j]))
            if len(best) >= self.k:
                best = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[: self.k])
                self.found[row] = best
                self.floor[row] = max(self.floor[row], min(best.values()))

    def sweep(self, ids: np.ndarray, points: np.ndarray) -> None:
        """Dual-tree traversal of the query tree and the tree of one block."""
        todo = [(np.inf, self.tree, cover_tree(points, np.arange(len(ids)), 0))]
        while todo:
            most, q, d = todo.pop()
            if most < self.floor[q.rows].min():
                continue
            for low in range(0, len(q.starts), WIDE):
                todo.extend(self._open(q, low, d, ids, points))

    def _open(self, q: Node, low: int, d: Node, ids: np.ndarray, points: np.ndarray) -> list[tuple[float, Node, Node]]:
        """Compares the children of ``q`` from number ``low`` on with those of ``d``: pairs of
        leaves are scored, the others that may hold a result are returned, the best last."""
        part = slice(low, low + WIDE)
        near, norms, radii = (x[part] for x in q.balls)
        other, other_norms, other_radii = d.balls
        bound = near @ other.T
        bound += np.outer(norms, other_radii) + np.outer(radii, other_norms + other_radii)
        bound += np.abs(bound) * 1e-9 + 1e-6  # rounding never prunes
        self.bounded += bound.size
        inside, others = (q.children or [q])[part], d.children or [d]
        leaf = np.array([not c.children for c in inside])
        other_leaf = np.array([not c.children for c in others])
        if other_leaf.any():
            for group in _groups(np.flatnonzero(leaf), q.sizes[part]):
                rows = np.concatenate([inside[i].rows for i in group])
                worst = np.minimum.reduceat(self.floor[rows], np.cumsum(q.sizes[part][group]) - q.sizes[part][group])
                alive = (bound[group] >= worst[:, None]).any(axis=0) & other_leaf
                if alive.any():
                    chosen = d.rows[np.repeat(alive, d.sizes)]
                    self.offer(rows, ids[chosen], points[chosen])
        if leaf.all() and other_leaf.all():
            return []
        worst = np.array([self.floor[c.rows].min() for c in inside])
        left, right = np.nonzero((bound >= worst[:, None]) & ~np.logical_and.outer(leaf, other_leaf))
        order = np.argsort(bound[left, right], kind="stable")
        return [(bound[i, j], inside[i], others[j]) for i, j in zip(left[order], right[order])]


def _groups(numbers: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``numbers`` in runs of about ``LEAF`` rows."""
    if len(numbers):
        filled = (np.cumsum(sizes[numbers]) - 1) // LEAF
        yield from np.split(numbers, np.flatnonzero(np.diff(filled)) + 1)


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)


def _assign(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = np.zeros(len(batch), dtype=np.int64)
            for dim, centres in pivots.items():
                at = np.flatnonzero(batch["dim"].to_numpy() == dim)
                for part in np.array_split(at, len(at) // 2048 + 1):
                    if len(part) and dim:
                        x = _matrix(batch["vec"].iloc[part])
                        cell[part] = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
            batch["cell"] = cell
            yield batch

    return run


def _sweep_blocks(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searches = {dim: Search(ids, points, floor.copy(), k, tree) for dim, (ids, points, floor, tree) in shared.value.items()}
        for group in segments(batches, ["dim", "cell", "block"]):
            for (dim, _, _), block in group.groupby(["dim", "cell", "block"], sort=False):
                if int(dim) in searches:
                    searches[int(dim)].sweep(block["vec_id"].to_numpy(), _matrix(block["vec"]).reshape(len(block), int(dim)))
        rows = [
            (int(s.ids[row]), other, int(score))
            for s in searches.values()
            for row, best in s.found.items()
            for other, score in best.items()
        ]
        yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _floors(ids: np.ndarray, points: np.ndarray, seed_ids: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that its k-th best row surely reaches."""
    floor = np.full(len(ids), -np.inf)
    _, first = np.unique(seed_ids, return_index=True)
    seed_ids, seeds = seed_ids[first], seeds[first]
    if len(seed_ids) > k:
        scores = points @ seeds.T
        scores[ids[:, None] == seed_ids[None, :]] = -np.inf
        floor = np.partition(scores, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]
    return floor


def top_k(
    rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` of the k best rows per query.

    ``is_query`` is a condition on ``vec_id``. Components are scaled and floored first.
    """
    spark = rows.sparkSession
    ship_package(spark)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vectors = settle(
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", number))
        .select(
            "vec_id",
            F.size("vec").cast("long").alias("dim"),
            F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec"),
        ),
        "vectors",
    )
    seeds = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).toPandas()
    seed_points = {int(d): (g["vec_id"].to_numpy(), _matrix(g["vec"]).reshape(len(g), int(d))) for d, g in seeds.groupby("dim")}
    pivots = {d: p[farthest_first(p, PIVOTS)] for d, (_, p) in seed_points.items()}
    celled = settle(vectors.mapInPandas(_assign(pivots), "vec_id long, dim long, vec array<double>, cell long"), "cells")
    blocks = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"))
    blocked = (
        celled.join(blocks, ["dim", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.col("blocks")))
        .drop("blocks")
        .repartition("dim", "cell", "block")
        .sortWithinPartitions("dim", "cell", "block")
    )
    queries = vectors.where(is_query)
    chunks = -(-queries.count() // QUERIES) or 1
    found = None
    for number_of in range(chunks):
        chunk = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == number_of).toPandas().sort_values("vec_id")
        told = {}
        for d, g in chunk.groupby("dim"):
            ids, points = g["vec_id"].to_numpy(), _matrix(g["vec"]).reshape(len(g), int(d))
            seed_ids, near = seed_points.get(int(d), (np.empty(0, np.int64), np.empty((0, int(d)))))
            tree = cover_tree(points, np.arange(len(ids)), 0)
            told[int(d)] = ids, points, _floors(ids, points, seed_ids, near, k), tree
        shared = spark.sparkContext.broadcast(told)
        part = settle(blocked.mapInPandas(_sweep_blocks(shared, k), "query_id long, vec_id long, score long"), "found")
        found = part if found is None else found.union(part)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
