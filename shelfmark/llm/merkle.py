"""Merkle manifest of a data set: leaf coordinates by bitmap rank, levels by slot arrays.

Every row is a leaf; the leaves of a group (say, a language) stand in the order of their
id and are reduced, two by two, to the group's subroot; the subroots, in the order of their
groups, are reduced to the root in the same way.

*Coordinates.* The ids of a group are a compressed bitmap: one 64-bit word for each run of
64 numbers that has an id at all, merged from the tasks' partial words by a bitwise or.
Words are gathered in chunks of 1,024; a popcount directory has the number of rows before
each chunk (a distributed prefix sum over chunks, not rows) and before each word of a
chunk. The rank of an id is the directory's entry of its word and the bits below its own,
so a row finds its coordinate by one join with its word, and rows are never sorted. An id
that several rows of a group share has one bit and a count beside it; only such rows are
put in order among themselves, by their leaves.

*Levels.* 2**``bits`` neighbouring leaves are a slot array, reduced inside one task to
their common ancestor; the ancestors are the leaves of the next round, until one is left.
Then the way down: each slot array learns the siblings above it, and every leaf gets its
proof from those of its own array and the ones above. Each round groups by (group, block),
so any number of rows means slot arrays of the same bounded size and log(rows) rounds.

A hash is SHA-256 over the concatenated inputs, digests as hex text. An odd node at the end
of a level is hashed alone; a group's lone leaf is its subroot.

Defined results: a null group comes before all others, a null id before all ids of its
group; repeated rows are leaves of their own; texts of any length are hashed whole; an
empty table has no rows in its manifest. Columns that are not named take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import segments, settle, ship_package
from shelfmark.operators.lookup import fits, lookup
from shelfmark.operators.ranking import prefix_sums

#: Leaves of a slot array, as a power of two.
BITS = 10
#: Words of 64 ids in a chunk of the bitmap, as a power of two.
CHUNK_BITS = 10


def leaf_hash(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as UTF-8 byte count, ``:`` and text, or ``-`` if null."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _sha(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode("ascii")).hexdigest()


# --- coordinates ---------------------------------------------------------------


def _word(ident: Column) -> Column:
    # a null id has a word of its own, before that of the smallest long
    return F.coalesce(F.shiftright(ident, 6), F.lit(-(1 << 60)).cast("long"))


def _bit(ident: Column) -> Column:
    return F.coalesce(ident.bitwiseAND(63), F.lit(0)).cast("int")


def bitmap(ids: DataFrame) -> DataFrame:
    """The words of the ids' bitmaps with their directory.

    ``ids``: ``key`` (sortable, not null), ``id`` and ``n``, the rows of that id. Returns
    ``key``, ``word``, ``bits``, ``more`` (bits of ids with several rows, and how many more
    these are) and ``before``, the rows of the group in front of the word.
    """
    more = F.when(F.col("n") > 1, F.struct(_bit(F.col("id")).alias("bit"), (F.col("n") - 1).alias("n")))
    words = settle(
        ids.groupBy("key", _word(F.col("id")).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(coalesce(id & 63, 0) AS INT))")).alias("bits"),
            F.sum("n").alias("rows"),
            F.collect_list(more).alias("more"),  # 64 entries at most
        ),
        "words",
    )
    chunk = F.shiftright("word", CHUNK_BITS).alias("chunk")
    chunks = prefix_sums(words.groupBy("key", chunk).agg(F.sum("rows").alias("rows")), ["key", "chunk"], "rows")
    firsts = chunks.groupBy("key").agg(F.min("_before").alias("first"))
    directory = chunks.join(firsts, "key").select("key", "chunk", (F.col("_before") - F.col("first")).alias("offset"))
    inside = Window.partitionBy("key", "chunk").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    return (
        words.withColumn("chunk", chunk)
        .withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .join(directory, ["key", "chunk"])
        .select("key", "word", "bits", "more", (F.col("offset") + F.col("inside")).alias("before"))
    )


def rank(ident: Column) -> Column:
    """Rows in front of all rows of an id, from its word's columns."""
    below = F.expr("~shiftleft(-1L, _bit)")
    more = F.aggregate(
        F.filter("more", lambda x: x["bit"] < F.col("_bit")), F.lit(0).cast("long"), lambda total, x: total + x["n"]
    )
    return F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below)) + more


def with_positions(kinds: DataFrame) -> DataFrame:
    """A row for each leaf: ``key``, ``id``, ``leaf``, ``claim`` and ``pos``, from 0 in each group.

    ``kinds`` (written) has equal leaves as one row, with their number ``n``.
    """
    ids = settle(kinds.groupBy("key", "id").agg(F.sum("n").alias("n")), "ids")
    words = bitmap(ids).withColumnRenamed("word", "_word")
    placed = kinds.withColumn("_word", _word(F.col("id"))).withColumn("_bit", _bit(F.col("id")))
    order = ["key", "id", "leaf", "claim"]
    ranked = settle(
        lookup(placed, words, ["key", "_word"], "inner", "leaf").select(
            *order, "n", rank(F.col("id")).alias("pos"), F.exists("more", lambda x: x["bit"] == F.col("_bit")).alias("shared")
        ),
        "ranked",
    )
    # rows of one id go in the order of their leaves
    shared = prefix_sums(ranked.where("shared").drop("shared"), order, "n")
    firsts = shared.groupBy("key", "pos").agg(F.min("_before").alias("first"))
    copies = (
        lookup(shared, firsts, ["key", "pos"], "inner", "leaf")
        .withColumn("pos", F.col("pos") + F.col("_before") - F.col("first"))
        .withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)")))
    )
    alone = ranked.where("NOT shared").select(*order, "pos")
    return alone.union(copies.select(*order, (F.col("pos") + F.col("copy")).alias("pos")))


# --- levels --------------------------------------------------------------------


def levels_of(nodes: list[str], levels: int) -> list[list[str]]:
    """A slot array's nodes, level by level; the last one has a single node."""
    out = [nodes]
    for _ in range(levels):
        nodes = out[-1]
        out.append([_sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)])
    return out


def _height(total: int, level: int, bits: int) -> int:
    """Levels that a slot array of a group goes up in the round that begins at ``level``.

    All of them where further nodes stand beside the array, else until one node is left.
    """
    nodes = -(-total >> level)
    return bits if nodes > 1 << bits else (nodes - 1).bit_length()


def _tops(level: int, bits: int):
    """One row per slot array: its ancestor, at the array's number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in segments(batches, ["key", "block"]):
            for (key, block), part in group.groupby(["key", "block"], sort=False):
                total = int(part["total"].iloc[0])
                top = levels_of(part["node"].tolist(), _height(total, level, bits))[-1][0]
                yield pd.DataFrame({"key": [key], "pos": [block], "node": [top], "total": [total]})

    return run


Siblings = list[tuple[int, str]]


def siblings(levels: list[list[str]], slot: int) -> Siblings:
    """For each level below the top: the slot's side (0 left) and its sibling, if any."""
    out = []
    for nodes in levels[:-1]:
        beside = slot ^ 1
        out.append((slot & 1, nodes[beside] if beside < len(nodes) else ""))
        slot >>= 1
    return out


def fold(node: str, way: Siblings) -> str:
    """The node reached from ``node`` along its siblings."""
    for side, beside in way:
        node = _sha(beside, node) if side else _sha(node, beside)
    return node


def _packed(way: Siblings) -> str:
    return ",".join(f"{side}{beside}" for side, beside in way)


def _unpacked(text: str) -> Siblings:
    return [(int(x[0]), x[1:]) for x in text.split(",")] if text else []


def _ways(level: int, bits: int):
    """For each node of a slot array its way up to the root, from that of the array."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in segments(batches, ["key", "block"]):
            for (key, _), part in group.groupby(["key", "block"], sort=False):
                above = part["way"].dropna()
                nodes = part[part["way"].isna()]
                height = _height(int(part["total"].iloc[0]), level, bits)
                levels = levels_of(nodes["node"].tolist(), height)
                rest = above.iloc[0]
                ways = [",".join(filter(None, (_packed(siblings(levels, s)), rest))) for s in range(len(nodes))]
                yield pd.DataFrame({"key": key, "pos": nodes["pos"], "total": nodes["total"], "way": ways})

    return run


def _proofs(bits: int):
    """Per leaf the hash of its siblings up to the root and the root its claim leads to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in segments(batches, ["key", "block"]):
            for _, part in group.groupby(["key", "block"], sort=False):
                rest = _unpacked(part["way"].dropna().iloc[0])
                beyond = "".join(beside for _, beside in rest)
                nodes = part[part["way"].isna()]
                levels = levels_of(nodes["node"].tolist(), _height(int(part["total"].iloc[0]), 0, bits))
                proof, reached = [], []
                for slot, claim in enumerate(nodes["claim"]):
                    way = siblings(levels, slot)
                    proof.append(_sha(*[beside for _, beside in way], beyond))
                    reached.append(fold(fold(claim, way), rest))
                yield pd.DataFrame(
                    {"key": nodes["key"], "id": nodes["id"], "leaf": nodes["node"], "proof": proof, "reached": reached}
                )

    return run


def _in_arrays(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", bits)).repartition("key", "block").sortWithinPartitions("key", "block", "pos")


_NODE = "key string, pos long, node string, total long"


def _reduce(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The written nodes of every round: those given, their ancestors, up to one per group.

    Groups of different size come down to one node in different rounds; such a node stays
    as it is in the rounds after.
    """
    rounds = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        arrays = _in_arrays(rounds[-1], bits)
        rounds.append(settle(arrays.mapInPandas(_tops(bits * (len(rounds) - 1), bits), _NODE), "tops"))
        most = -(-most >> bits)
    return rounds


def manifest(
    rows: DataFrame, group: Column, ident: Column, leaf: Column, claim: Column | None = None, bits: int = BITS
) -> DataFrame:
    """One row per leaf: ``id``, ``leaf``, ``subroot``, ``root``, ``proof`` and ``reached``.

    ``leaf`` is the digest that the manifest records, ``claim`` (default: the same) the one
    that is checked against it: ``reached`` is the root recomputed from the claim with the
    siblings of the manifest, and equals ``root`` only for an unchanged row. ``proof`` is
    the hash of these siblings, from the leaf up to the root.
    """
    ship_package(rows.sparkSession)
    # a null group sorts before the empty one; the mark keeps the order of the bytes
    key = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("key")
    claim = leaf if claim is None else claim
    leaves = rows.select(key, ident.cast("long").alias("id"), leaf.alias("leaf"), claim.alias("claim"))
    kinds = settle(leaves.groupBy("key", "id", "leaf", "claim").agg(F.count("*").alias("n")), "leaves")
    totals = settle(kinds.groupBy("key").agg(F.sum("n").alias("total")), "totals")
    few = fits(totals)
    placed = settle(lookup(with_positions(kinds), totals, ["key"], "inner", "leaf", small=few), "placed")

    below = _reduce(placed.select("key", "pos", F.col("leaf").alias("node"), "total"), bits)
    subroots = below[-1].select("key", F.col("node").alias("subroot"))
    numbered = prefix_sums(subroots.withColumn("one", F.lit(1)), ["key"], "one")
    tops = settle(
        numbered.select(
            F.lit("").alias("key"),
            F.col("_before").cast("long").alias("pos"),
            F.col("subroot").alias("node"),
            F.lit(totals.count()).cast("long").alias("total"),
            F.col("key").alias("group"),
        ),
        "groups",
    )
    above = _reduce(tops.drop("group"), bits)
    # the way of a group's subroot is where the ways inside the group go on
    ways = _descend(above, above[-1].select("key", "pos", "total", F.lit("").alias("way")), 0, bits)
    inside = tops.join(ways.select("key", "pos", "way"), ["key", "pos"]).select(F.col("group").alias("key"), "way")
    start = inside.join(totals, "key").select("key", F.lit(0).cast("long").alias("pos"), "total", "way")
    upper = _descend(below, start, 1, bits)
    # ids as text, as pandas has no nullable long
    known = placed.select("key", "pos", F.col("leaf").alias("node"), "total", F.col("id").cast("string").alias("id"), "claim")
    proofs = _with_ways(known, upper, bits).mapInPandas(
        _proofs(bits), "key string, id string, leaf string, proof string, reached string"
    )
    return lookup(proofs, subroots, ["key"], "inner", "leaf", small=few).select(
        F.col("id").cast("long").alias("id"),
        "leaf",
        "subroot",
        above[-1].select("node").scalar().alias("root"),
        "proof",
        "reached",
    )


def _with_ways(nodes: DataFrame, ways: DataFrame, bits: int) -> DataFrame:
    """Slot arrays of ``nodes``, each with a row for the way on from the array's top."""
    arrays = ways.withColumn("block", F.col("pos")).withColumn("pos", F.expr(f"shiftleft(pos, {bits}) - 1"))
    both = nodes.withColumn("block", F.shiftright("pos", bits)).unionByName(arrays, allowMissingColumns=True)
    return both.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def _descend(rounds: list[DataFrame], ways: DataFrame, stop: int, bits: int) -> DataFrame:
    """``key``, ``pos``, ``total``, ``way``: the way to the top of every node of round ``stop``.

    ``ways`` has the way on from each group's last node.
    """
    for number in range(len(rounds) - 2, stop - 1, -1):
        arrays = _with_ways(rounds[number], ways, bits)
        ways = settle(arrays.mapInPandas(_ways(bits * number, bits), "key string, pos long, total long, way string"), "ways")
    return ways
