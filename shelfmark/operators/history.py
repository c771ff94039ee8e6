"""Type-2 history of products: new rows, changed rows, expiry, and the daily load."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.calendar import date_fk
from shelfmark.operators.checks import duplicate_keys
from shelfmark.operators.lookup import all_present, fits, lookup
from shelfmark.operators.ranking import number_rows
from shelfmark.schemas import COMPARED, DIMENSION, DIMENSION_SCHEMA, KEYS, NEVER, PRODUCT
from shelfmark.session import settle

NEW, CHANGED = 0, 1


def current_rows(dim: DataFrame) -> DataFrame:
    """Versions that are neither deleted nor expired; both filters reach the scan."""
    return dim.filter((F.col("isDelete") == F.lit(False)) & (F.col("expired_date") == F.lit(NEVER).cast("date")))


def any_differs(left: DataFrame, right: DataFrame, columns: Sequence[str] = COMPARED) -> Column:
    """At least one column differs; a NULL on either side is no difference."""
    return reduce(lambda a, b: a | b, [left[c] != right[c] for c in columns])


def with_key_collation(df: DataFrame, collation: str = "UNICODE_CI_AI_RTRIM") -> DataFrame:
    """Compare product keys without regard to case, accents and trailing spaces.

    Apply to every table that takes part. The default of all operators is binary
    comparison.
    """
    return df.withColumns({k: F.collate(F.col(k), collation) for k in KEYS})


def _accents() -> tuple[str, str]:
    """Letters with accents and what they are without; then the accents themselves."""
    letters, plain, marks = [], [], []
    for char in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x30000))):
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base, *rest = unicodedata.normalize("NFD", char)
        if rest and all(unicodedata.category(c) == "Mn" for c in rest):
            letters.append(char)
            plain.append(base)
    return "".join(letters + marks), "".join(plain)


#: Columns of the normalised key, next to the key itself.
NORMAL = ("_product_name_key", "_manufacturer_key")


def normalised(text: Column) -> Column:
    """The text without regard to case, accents and trailing spaces, as a plain text that
    hashes and compares by its bytes."""
    return F.lower(F.translate(F.rtrim(text), *_accents()))


def with_normal_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({n: normalised(F.col(k)) for n, k in zip(NORMAL, KEYS)})


def _seen_keys(dim: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys of every version, also deleted ones, collapsed before the shuffle."""
    return dim.filter(all_present(keys)).groupBy(*keys).agg(F.lit(True).alias("_seen"))


def _compared(keyed: DataFrame, dim: DataFrame, small: bool, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per row of the batch (``_row``, its id) whose key some version carries: the number
    ``n`` of current versions, and whether one of them differs (``_differs``).

    One scan of the dimension. Versions are compared row by row, a hot key in slices, so
    that only fixed-width values are aggregated; texts would be sorted for it.
    """
    batch = keyed.select(F.col("id").alias("_row"), *keys, *[F.col(c).alias(f"_new_{c}") for c in COMPARED])
    live = (F.col("isDelete") == F.lit(False)) & (F.col("expired_date") == F.lit(NEVER).cast("date"))
    versions = dim.filter(all_present(keys)).select("id", *keys, *COMPARED, F.coalesce(live, F.lit(False)).alias("_live"))
    pairs = lookup(versions, batch, keys, "inner", "id", small=small)
    differs = reduce(lambda a, b: a | b, [F.col(c) != F.col(f"_new_{c}") for c in COMPARED])
    return pairs.groupBy("_row").agg(
        F.count_if("_live").alias("n"), F.max(F.col("_live") & F.coalesce(differs, F.lit(False))).alias("_differs")
    )


def _only_keys_of(dim: DataFrame, stg: DataFrame, small: bool) -> DataFrame:
    """Rows of ``dim`` that a counted small batch can concern, without a shuffle."""
    if not small:
        return dim
    return dim.join(F.broadcast(stg.select(*KEYS)), list(KEYS), "left_semi").select(*dim.columns)


def new_products(stg: DataFrame, dim: DataFrame, small: bool | None = None) -> DataFrame:
    """Rows of the batch whose key no version carries; a NULL key is always new.

    ``stg`` holds one row per complete key, as de-duplication leaves it, so neither
    side of the join can have a hot key; rows with a NULL key never enter it.
    """
    small = fits(stg) if small is None else small
    keyed = stg.filter(all_present(KEYS))
    seen = _seen_keys(_only_keys_of(dim, keyed, small))
    fresh = keyed.join(seen, list(KEYS), "left_anti").select(*stg.columns)
    return fresh.unionByName(stg.filter(~all_present(KEYS)))


def changed_products(stg: DataFrame, dim: DataFrame, small: bool | None = None) -> DataFrame:
    """Rows of the batch that differ from a current version of their key.

    Adds ``n``, the number of current versions of the key.
    """
    small = fits(stg) if small is None else small
    keyed = stg.filter(all_present(KEYS))
    changed = _compared(keyed, dim, small).filter("_differs")
    return keyed.join(changed, keyed["id"] == changed["_row"]).select(*[keyed[c] for c in stg.columns], "n")


def classify(
    stg: DataFrame, dim: DataFrame, small: bool | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """New and changed rows of a batch in one pass, marked in ``_action``.

    ``stg`` holds one row per complete key, as de-duplication leaves it.
    """
    small = fits(stg) if small is None else small
    keyed = stg.filter(all_present(keys))
    compared = _compared(keyed, dim, small, keys)
    action = F.when(F.col("_row").isNull(), NEW).when(F.col("_differs"), CHANGED)
    matched = (
        keyed.join(compared, keyed["id"] == compared["_row"], "left")
        .withColumn("_action", action)
        .filter(F.col("_action").isNotNull())
        .select(*[keyed[c] for c in stg.columns], "_action", "n")
    )
    loose = stg.filter(~all_present(keys)).withColumns({"_action": F.lit(NEW), "n": F.lit(None).cast("long")})
    return matched.unionByName(loose)


def classify_parts(stg: DataFrame, opened: DataFrame, closed: DataFrame, small: bool | None = None) -> DataFrame:
    """:func:`classify` against a dimension whose closed versions lie apart.

    Of the closed versions only the keys are read, and only for rows of the batch that no
    open version knows.
    """
    small = fits(stg) if small is None else small
    keyed = stg.filter(all_present(KEYS))
    compared = _compared(keyed, opened, small)
    matched = settle(
        keyed.join(compared, keyed["id"] == compared["_row"], "left").select(*[keyed[c] for c in stg.columns], "n", "_row", "_differs"),
        "matched",
    )
    changed = matched.filter("_differs").withColumn("_action", F.lit(CHANGED))
    unknown = matched.filter("_row IS NULL").drop("n").withColumn("n", F.lit(None).cast("long"))
    seen = _seen_keys(_only_keys_of(closed, unknown, small))
    fresh = unknown.join(seen, list(KEYS), "left_anti").withColumn("_action", F.lit(NEW))
    loose = stg.filter(~all_present(KEYS)).withColumns({"_action": F.lit(NEW), "n": F.lit(None).cast("long")})
    columns = [*stg.columns, "_action", "n"]
    return fresh.select(*columns).unionByName(changed.select(*columns)).unionByName(loose.select(*columns))


def expire_ids(dim: DataFrame, changed: DataFrame, small: bool | None = None) -> DataFrame:
    """Ids of all current versions of the changed keys."""
    keys = changed.select(*KEYS).distinct()
    small = fits(keys) if small is None else small
    rows = current_rows(dim).filter(all_present(KEYS)).select("id", *KEYS)
    return lookup(rows, keys, KEYS, "left_semi", "id", small=small).select("id").distinct()


def _expired(dim: DataFrame, hit: Column, as_of: Column) -> DataFrame:
    return dim.withColumns(
        {
            "isDelete": F.when(hit, F.lit(True)).otherwise(F.col("isDelete")),
            "expired_date": F.when(hit, as_of).otherwise(F.col("expired_date")),
            "date_delete": F.when(hit, as_of).otherwise(F.col("date_delete")),
        }
    )


def expire(dim: DataFrame, ids: DataFrame, as_of: str, small: bool | None = None) -> DataFrame:
    """Mark the versions with the given ids as deleted on ``as_of``."""
    small = fits(ids) if small is None else small
    marks = ids.select(F.col("id").alias("_expire")).distinct()
    marks = F.broadcast(marks) if small else marks
    joined = dim.join(marks, dim["id"] == marks["_expire"], "left")
    return _expired(joined, F.col("_expire").isNotNull(), F.lit(as_of).cast("date")).select(*dim.columns)


def expire_keys(
    dim: DataFrame, keys: DataFrame, as_of: str, small: bool, on: Sequence[str] = KEYS
) -> DataFrame:
    """Mark all current versions of the given keys (columns: key, ``n``).

    Past versions cannot change, so they bypass the join; with few keys the current
    ones are matched by a broadcast and the dimension is not shuffled at all.
    """
    is_live = (
        (F.col("isDelete") == F.lit(False)) & (F.col("expired_date") == F.lit(NEVER).cast("date")) & all_present(on)
    )
    day = F.lit(as_of).cast("date")
    marks = keys.select(*on, F.lit(True).alias("_hit"))
    if small:
        joined = dim.join(F.broadcast(marks), list(on), "left")
        return _expired(joined, F.col("_hit") & is_live, day).select(*dim.columns)
    live = lookup(dim.filter(is_live), marks, on, "left", "id", counts=keys)
    past = dim.filter(~F.coalesce(is_live, F.lit(False)))
    return past.unionByName(_expired(live, F.col("_hit"), day).select(*dim.columns))


def with_defaults(df: DataFrame, as_of: str) -> DataFrame:
    """Values a row gets when it enters the dimension on ``as_of``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumns(
        {
            "created_at": now,
            "isDelete": F.lit(False),
            "date_delete": F.lit(None).cast("date"),
            "date_insert": now,
            "expired_date": F.lit(NEVER).cast("date"),
            "date_insert_fk": F.lit(None).cast("int"),
        }
    )


def scd2_load(
    dim: DataFrame, stg: DataFrame, calendar: DataFrame, as_of: str | datetime, normal: bool = False
) -> DataFrame:
    """The dimension after loading one batch on ``as_of``, as a new snapshot.

    New products and changed products (in that order, each by staging id) continue
    the surrogate keys; every current version of a changed key is expired. The batch
    decides the plan: it is classified once, written out and counted, and a small
    one is broadcast so that the dimension itself is only scanned. With ``normal`` keys are
    the same without regard to case, accents and trailing spaces.
    """
    keys = KEYS
    if normal:
        keys, dim, stg = NORMAL, with_normal_keys(dim), with_normal_keys(stg)
    as_of = str(as_of)
    day = as_of[:10]
    repeated = duplicate_keys(stg.where(all_present(keys)), keys).first()
    if repeated is not None:
        raise ValueError(f"a batch has one row per key, this one repeats {tuple(repeated)}")
    small = fits(stg)
    batch = settle(classify(stg, dim, small, keys))
    changed_keys = batch.filter(F.col("_action") == CHANGED).groupBy(*keys).agg(F.max("n").alias("n"))
    kept = expire_keys(dim, changed_keys, day, small or fits(changed_keys), keys)

    top = dim.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    numbered = number_rows(batch.select("_action", "id", *PRODUCT, "source"), "id", top, lead=["_action"])
    added = with_defaults(numbered.withColumn("id", F.col("_number")), as_of)
    added = added.select(*[F.col(f.name).cast(f.dataType) for f in DIMENSION_SCHEMA])
    return date_fk(kept.select(*DIMENSION).unionByName(added), calendar)
