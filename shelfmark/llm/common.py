"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import settle, ship_package

__all__ = ["WORD", "base_lower", "fold", "free_names", "labelled_sample", "pieces", "segments", "settle", "ship_package", "table"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Those names, longer where ``docs`` has a column of that name in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(doc_id: Column, modulus: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; a null id gives null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def base_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, training: Column, bound: int) -> DataFrame:
    """Texts (``doc_id``, ``text``, ``y``) of at most ``bound`` labelled ids.

    The ids are those with the smallest hash among the labels that ``training`` selects,
    so the choice is the same in every run and, below the bound, takes every label. A
    label counts if it is 0 or 1; an id with several labels takes the largest, an id with
    several texts the first of them in order, so the bound holds for texts too. The
    bounded id list is what the join broadcasts.
    """
    chosen = (
        labels.where(training & F.col(target).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(target).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of an id that several rows have, the first text in their order, a null one last
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def pieces(texts: pd.Series, limit: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of many texts, about ``limit`` at a time, and the text each belongs to.

    A longer text comes in several pieces that share ``overlap`` code points, so every
    n-gram of up to ``overlap`` + 1 characters lies whole in one piece.
    """
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        if not text:
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        start = 0
        while True:
            part = points[start : start + limit]
            held.append(part)
            owner.append(number)
            size += len(part)
            if size >= limit:
                yield np.concatenate(held), np.repeat(np.array(owner, dtype=np.int32), [len(x) for x in held])
                held, owner, size = [], [], 0
            start += limit - overlap
            if start + overlap >= len(points):
                break
    if held:
        yield np.concatenate(held), np.repeat(np.array(owner, dtype=np.int32), [len(x) for x in held])


def segments(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole key groups from a partition that is sorted by ``keys``.

    Only the last, perhaps unfinished group of a batch is held over.
    """
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in keys]
        change = np.zeros(len(batch) - 1, dtype=bool)
        for values in columns:
            change |= values[1:] != values[:-1]
        same = bool(rest) and all(rest[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys)
        last = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        if not last:
            if not same and rest:
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(batch)
            continue
        yield pd.concat([*rest, batch.iloc[:last]], ignore_index=True)
        rest = [batch.iloc[last:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)
