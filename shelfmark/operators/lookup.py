"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 1_000_000
NULL_LANES = 4096


def all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``BROADCAST_BYTES`` of texts.

    A plain count: it is combined on the map side, and a stored table is counted from
    its footers. A limit before the count would gather rows in one task instead. The
    texts are measured only where the count is within its bound.
    """
    if df.count() > max_rows:
        return False
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    if not sizes:
        return True
    total = df.agg(F.sum(reduce(lambda a, b: a + b, sizes).cast("long"))).first()[0]
    return (total or 0) <= BROADCAST_BYTES


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    slice_by: str,
    counts: DataFrame | None = None,
    small: bool = False,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Equi-join ``left`` with ``right``, which has one row per key.

    ``small``: the caller has counted ``right`` and found it within
    ``BROADCAST_ROWS``; it is broadcast and ``left`` is not shuffled. Otherwise both
    sides are shuffled on the keys and a *slice*: a key with more than
    ``rows_per_task`` rows (default ``ROWS_PER_TASK``) on the left is cut into slices
    by a hash of ``slice_by``, and its one right row is repeated per slice. There are
    at most rows / ``rows_per_task`` such keys, which bounds their broadcast. Rows
    with a NULL key match nothing and are spread out. ``counts`` may hand in the keys
    with their row count ``n`` where the caller has them anyway.
    """
    keys = list(keys)
    rows_per_task = rows_per_task or ROWS_PER_TASK
    if small:
        return left.join(F.broadcast(right), keys, how)
    if counts is None:
        counts = left.filter(all_present(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    hot = counts.filter(F.col("n") > rows_per_task).select(
        *keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_slices")
    )
    hash_of_row = F.xxhash64(F.col(slice_by))
    sliced_left = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_slice",
        F.when(~all_present(keys), F.pmod(hash_of_row, F.lit(NULL_LANES)))
        .otherwise(F.pmod(hash_of_row, F.coalesce(F.col("_slices"), F.lit(1))))
        .cast("int"),
    )
    sliced_right = (
        right.join(F.broadcast(hot), keys, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return sliced_left.drop("_slices").join(sliced_right, [*keys, "_slice"], how).drop("_slice")
