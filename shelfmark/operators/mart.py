"""Data mart of the products that are current in the warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.history import NORMAL, with_normal_keys
from shelfmark.operators.lookup import all_present, fits, lookup
from shelfmark.schemas import COMPARED, KEYS, MART
from shelfmark.session import settle

_NAME = "product_name"
_VALUES = tuple(c for c in MART if c not in KEYS)


def _undeleted(dw: DataFrame) -> DataFrame:
    return dw.filter(F.col("isDelete") == F.lit(False)).select(*MART)


def _keyed(mart: DataFrame, rows: DataFrame, normal: bool) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    return (with_normal_keys(mart), with_normal_keys(rows), NORMAL) if normal else (mart, rows, KEYS)


def mart_update(mart: DataFrame, dw: DataFrame, normal: bool = False) -> DataFrame:
    """Take over all values, also the id, of products that differ in the warehouse.

    Should a key have several current versions, the one with the highest id counts.
    Both sides have one row per key; the warehouse's is found by a map-side aggregate of
    ids, which pick their rows, so that no text is aggregated.
    """
    mart, rows, keys = _keyed(mart, _undeleted(dw).filter(all_present(KEYS)), normal)
    ids = rows.groupBy(*keys).agg(F.max("id").alias("id")).select("id")
    latest = rows.join(ids, "id", "left_semi").select(*keys, F.struct(*_VALUES).alias("_dw"))
    differs = F.coalesce(reduce(lambda a, b: a | b, [F.col(c) != F.col(f"_dw.{c}") for c in COMPARED]), F.lit(False))
    joined = mart.join(latest, list(keys), "left").withColumn("_differs", differs)
    return joined.select(
        *[
            F.col(c) if c in KEYS else F.when(F.col("_differs"), F.col(f"_dw.{c}")).otherwise(F.col(c)).alias(c)
            for c in MART
        ]
    )


def mart_insert(mart: DataFrame, dw: DataFrame, normal: bool = False) -> DataFrame:
    """Current warehouse rows whose *name* is not in the mart, with NOT IN rules.

    A NULL name in the mart means no row qualifies; a NULL name in the warehouse
    qualifies only for an empty mart. The match is on the name alone, although the
    mart's key is name and manufacturer. A null-aware anti join would broadcast all
    names of the mart, so the NULL rules are taken from one scalar and the rest is
    an ordinary join of distinct names; only the missing names go back to the rows. As the
    mart holds a key once, of several current versions the one with the highest id goes in.
    """
    mart, rows, keys = _keyed(mart, _undeleted(dw), normal)
    name = keys[0]
    state = F.when(F.count("*") == 0, "empty").when(F.max(F.col(_NAME).isNull()), "null").otherwise("plain")
    mart_state = mart.agg(state).scalar()
    names = rows.filter(F.col(_NAME).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    missing = settle(names.join(mart.select(name).distinct(), name, "left_anti"))
    found = lookup(
        rows, missing.select(name), [name], "left_semi", "id", counts=missing, small=fits(missing)
    )
    latest = found.groupBy(*keys, F.when(~all_present(keys), F.col("id")).alias("_alone")).agg(F.max("id").alias("id"))
    found = found.join(latest.select("id"), "id", "left_semi").select(*MART)
    nameless = rows.filter(F.col(_NAME).isNull() & (mart_state == "empty"))
    return found.filter(mart_state != "null").unionByName(nameless.select(*MART))


def mart_delete(mart: DataFrame, dw: DataFrame) -> DataFrame:
    """Mart rows that stay: their id is not deleted in the warehouse."""
    deleted = dw.filter(F.col("isDelete") == F.lit(True)).select("id")
    return mart.join(deleted, "id", "left_anti").select(*MART)


def mart_sync(mart: DataFrame, dw: DataFrame, normal: bool = False) -> DataFrame:
    """Update, insert, delete, in this order.

    The update moves a changed product to the id of its new version, which is why
    the delete, which removes ids of old versions, spares it. With ``normal`` names and
    manufacturers are the same without regard to case, accents and trailing spaces.
    """
    updated = mart_update(mart, dw, normal)
    return mart_delete(updated.unionByName(mart_insert(mart, dw, normal)), dw)
