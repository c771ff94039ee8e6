"""Running totals and dense row numbers without a one-task global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.session import settle

ROWS_PER_BUCKET = 250_000


def running_totals(buckets: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """Add ``_before``, the sum of ``value`` over all earlier buckets.

    The input holds one row per bucket of rows, not per row: with the bucket sizes
    used here, ten billion rows are 40,000 buckets, so one task orders them.
    """
    earlier = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return buckets.withColumn("_before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def in_ranges(df: DataFrame, order: Sequence[str], rows: int, rows_per_range: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``_range``: rows of a lower range come before all rows of a higher one.

    ``rows`` is the row count. The ranges are cut by quantiles of a sample, so they hold
    about the same number of rows however the values are spread, as long as ``order`` is
    (nearly) unique. As every run would draw another sample, the placed rows are written
    once; a lost executor reads them again.
    """
    ranges = rows // rows_per_range + 1
    if ranges == 1:
        return df.withColumn("_range", F.lit(0))
    return settle(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def prefix_sums(
    df: DataFrame, order: Sequence[str], value: str, rows_per_range: int = ROWS_PER_BUCKET, out: str = "_before"
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows that come before in ``order``.

    ``order`` names columns that tell all rows apart; NULL comes first. Sums are taken
    inside ranges in parallel; only one total per range is ordered globally and comes
    back through a broadcast of one row per range.
    """
    placed = in_ranges(df, order, df.count(), rows_per_range)
    totals = running_totals(placed.groupBy("_range").agg(F.sum(value).alias("_sum")), ["_range"], "_sum")
    earlier = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_within", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .join(F.broadcast(totals.select("_range", F.col("_before").alias("_offset"))), "_range")
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop("_range", "_within", "_offset")
    )


def number_rows(
    df: DataFrame, id_col: str, start: Column | int = 0, lead: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``_number``: ``start`` + 1, + 2, ... in the order of ``lead`` and ``id_col``.

    ``id_col`` is a unique number. Rows are dealt out in ranges of equal size, so neither
    sparse numbers nor a few far away from the rest put many rows into one task.
    """
    base = start if isinstance(start, Column) else F.lit(start)
    numbered = prefix_sums(df.withColumn("_one", F.lit(1)), [*lead, id_col], "_one", rows_per_bucket)
    return numbered.withColumn("_number", base + F.col("_before") + 1).drop("_before", "_one")
