"""The manifest against a plain Merkle tree, with nulls, repeats and groups of many sizes."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import merkle


def _h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def _brute(rows):
    """(id, leaf, subroot, root, proof, reached) of rows (group, id, leaf, claim)."""
    groups = {}
    for group, ident, leaf, claim in rows:
        groups.setdefault(group, []).append((ident is not None, ident or 0, leaf, claim, ident))
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([x[2] for x in sorted(groups[g], key=lambda x: x[:4])]) for g in keys}
    top = _levels([trees[g][-1][0] for g in keys])
    out = []
    for place, g in enumerate(keys):
        for pos, (_, _, leaf, claim, ident) in enumerate(sorted(groups[g], key=lambda x: x[:4])):
            node, beside = claim, ""
            for tree, at in ((trees[g], pos), (top, place)):
                for nodes in tree[:-1]:
                    other = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
                    node = _h(other, node) if at & 1 else _h(node, other)
                    beside += other
                    at >>= 1
            out.append((ident, leaf, trees[g][-1][0], top[-1][0], _h(beside), node))
    return out


def _got(spark, rows, bits=10):
    df = spark.createDataFrame(rows, "grp string, id long, leaf string, claim string").repartition(3)
    found = merkle.manifest(df, F.col("grp"), F.col("id"), F.col("leaf"), F.col("claim"), bits)
    return [tuple(r) for r in found.select("id", "leaf", "subroot", "root", "proof", "reached").collect()]


def _order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if x is not None else (False, "") for x in map(str, r)))


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_against_a_plain_tree(spark, bits):
    rng = random.Random(bits)
    rows = []
    for group, size in ((None, 7), ("", 1), ("a", 33), ("é", 2), ("z", 64), ("b", 5)):
        ids = rng.sample([-(2**63), 2**63 - 1, -5, -1, 0, *range(1, 150), 2**40], size)
        for i in ids:
            leaf = _h(str(rng.random()))
            rows.append((group, i, leaf, leaf if rng.random() < 0.7 else _h("changed")))
    rows += [("a", 3, _h("x"), _h("x"))] * 3 + [("a", 3, _h("y"), _h("y")), ("a", None, _h("n"), _h("n")), ("a", None, _h("m"), _h("m"))]
    assert _order(_got(spark, rows, bits)) == _order(_brute(rows))


def test_one_row_and_no_row(spark):
    assert _got(spark, []) == []
    (row,) = _got(spark, [("g", 4, _h("leaf"), _h("other"))])
    assert row == (4, _h("leaf"), _h("leaf"), _h("leaf"), _h(""), _h("other"))


def test_ranks_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CHUNK_BITS", 1)
    rng = random.Random(4)
    ids = sorted(rng.sample(range(-3000, 3000), 700) + [2**60, -(2**62)])
    rows = [("g", i, _h(str(i)), _h(str(i))) for i in ids]
    assert _order(_got(spark, rows)) == _order(_brute(rows))


def test_leaf_hash(spark):
    df = spark.createDataFrame([(1, "é", None, "x" * 100_000), (None, "", "-", None)], "a long, b string, c string, d string")
    got = [r[0] for r in df.select(merkle.leaf_hash([F.col(c) for c in "abcd"])).collect()]
    assert got == [_h("1:12:é-100000:" + "x" * 100_000), _h("-0:1:--")]
