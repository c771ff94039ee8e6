"""Constraints the tables declare, checked by query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.lookup import lookup
from shelfmark.session import settle


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, row_id: str) -> DataFrame:
    """Rows of ``fact`` whose non-NULL key is missing in ``dim``.

    The distinct keys are compared first, with their counts; only keys without a
    match go back to the rows, and those counts cut a hot one into slices.
    """
    keys = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n"))
    lost = settle(keys.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti"), "lost")
    return lookup(fact, lost.select(fk), [fk], "left_semi", row_id, counts=lost).select(*fact.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def violations(
    df: DataFrame,
    row_id: str,
    domains: dict[str, Sequence[str]] | None = None,
    required: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
) -> DataFrame:
    """One row (``row_id``, ``rule``) per broken rule, in a single scan.

    Rules: ``domain:c`` (value not listed), ``null:c``, ``length:c`` (too long).
    """
    rules = []
    for column, values in (domains or {}).items():
        rules.append((f"domain:{column}", ~F.col(column).isin(*values)))
    for column in required:
        rules.append((f"null:{column}", F.col(column).isNull()))
    for column, limit in (lengths or {}).items():
        rules.append((f"length:{column}", F.char_length(column) > limit))
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))
    return df.select(row_id, F.explode(broken).alias("rule"))
