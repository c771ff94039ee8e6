"""The dual-tree search: invariants of the trees, what pruning saves, odd tables."""

import numpy as np
import pytest

from shelfmark.llm import topk


def nodes(root):
    todo = [root]
    while todo:
        yield (node := todo.pop())
        todo += node.children


def vectors(shape, size, dim, seed=3):
    draw = np.random.default_rng(seed)
    if shape == "random":
        return np.floor(256 * draw.normal(size=(size, dim)))
    centres = draw.normal(size=(60, dim))
    return np.floor(256 * (centres[draw.integers(0, 60, size)] + draw.normal(size=(size, dim)) / 50))


@pytest.mark.parametrize("shape,dim", [("random", 40), ("clustered", 6), ("clustered", 40)])
def test_trees_are_whole(shape, dim):
    points = np.concatenate([vectors(shape, 1500, dim), np.zeros((100, dim))])
    seen = []
    for node in nodes(topk.cover_tree(points, np.arange(len(points)), 5)):
        if not node.children:
            assert len(node.rows) <= topk.LEAF or node.radius == 0
            seen += node.rows.tolist()
            continue
        # a child's rows are its part of the node's rows, in an order of its own
        for child, low, size in zip(node.children, node.starts, node.sizes):
            assert sorted(child.rows) == sorted(node.rows[low : low + size])
        assert any((c.centre == node.centre).all() for c in node.children)
        assert max(c.radius for c in node.children) <= node.radius / 2 * (1 + 1e-9)
        centres = np.array([c.centre for c in node.children])
        for i in range(1, len(centres)):
            assert np.sqrt(((centres[:i] - centres[i]) ** 2).sum(axis=1)).min() > node.radius / 2 * (1 - 1e-9)
    assert sorted(seen) == list(range(len(points)))


@pytest.mark.parametrize("shape,dim,most", [("clustered", 6, 0.2), ("clustered", 64, 0.05), ("random", 64, 0.1)])
def test_pruning_spares_most_scores(shape, dim, most):
    """The k best are exact although only a small share of the pairs is scored."""
    data, k = vectors(shape, 8192, dim), 5
    ids = np.arange(len(data))
    queries = ids[::20]
    seeds = np.random.default_rng(1).choice(ids, 1024, replace=False)
    search = topk.Search(queries, data[queries], topk._floors(queries, data[queries], seeds, data[seeds], k), k)
    for part in np.array_split(ids, 4):
        search.sweep(part, data[part])
    pairs = len(queries) * len(ids)
    assert search.scored < most * pairs
    # on clusters hardly any bound is computed either; random vectors have no groups to prune
    assert search.bounded < (0.05 if shape == "clustered" else 1.01) * pairs
    scores = data[queries] @ data.T
    scores[np.arange(len(queries)), queries] = -np.inf
    for i in range(len(queries)):
        want = sorted(((-scores[i, j], j) for j in np.flatnonzero(scores[i] >= np.sort(scores[i])[-k])))[:k]
        assert sorted((-s, j) for j, s in search.found[i].items())[:k] == want


def test_equal_rows_and_single_rows():
    same = np.tile(np.array([3.0, -4.0]), (500, 1))
    ids = np.arange(500)
    search = topk.Search(ids[:3], same[:3], np.full(3, -np.inf), 5)
    search.sweep(ids, same)
    assert {i: sorted(best) for i, best in search.found.items()} == {0: [1, 2, 3, 4, 5], 1: [0, 2, 3, 4, 5], 2: [0, 1, 3, 4, 5]}
    alone = topk.Search(ids[:1], same[:1], np.full(1, -np.inf), 5)
    alone.sweep(ids[:1], same[:1])
    assert alone.found == {}
