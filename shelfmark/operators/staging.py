"""From all-text rows of a feed to clean typed rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import attributes as A
from shelfmark.functions.images import image_list
from shelfmark.schemas import FEEDS, KEYS, RENAMED, STAGING, FeedSpec

RAW_KEYS = tuple(old for key in KEYS for old, new in RENAMED.items() if new == key)


def to_typed(raw: DataFrame, feed: FeedSpec | str, ignore_case: bool = False, image: Column | None = None) -> DataFrame:
    """Normalise one feed's text columns into the staging layout.

    A map-only job: one projection, no shuffle. ``image`` replaces the per-row
    image list of feed A, e.g. by the table-wide one.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    if feed.name == "a":
        sized = A.with_size_a(raw, "size", ignore_case)
        price, weight = A.parse_price_a(F.col("price"), ignore_case), A.parse_weight_a(F.col("weight"), ignore_case)
        image = image_list(F.col("images")) if image is None else image
    else:
        sized = A.with_size_b(raw, "size", ignore_case)
        price, weight = A.parse_price_b(F.col("price"), ignore_case), A.parse_weight_b(F.col("weight"), ignore_case)
        image = F.col("images") if image is None else image
    renamed = {new: F.col(old) for old, new in RENAMED.items()}
    values = {**renamed, "price": price, "weight": weight, "image": image, "source": F.lit(feed.source)}
    return sized.select(*[values.get(c, F.col(c)).alias(c) for c in STAGING])


def dedup_keep_first(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "id") -> DataFrame:
    """Per key keep the row with the lowest ``order``, a unique number; rows with a
    NULL key all stay.

    Not a window, which would send all copies of a key to one task: the lowest
    numbers are found from the key columns alone, collapsing copies on the map side,
    and pick their rows by a join on ``order``, which is spread evenly whatever the
    keys are. Rows with a NULL key are groups of their own.
    """
    keys = list(keys)
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    alone = F.when(incomplete, F.col(order)).alias("_alone")
    first = df.groupBy(*keys, alone).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi").select(*df.columns)


def drop_incomplete(df: DataFrame, required: Sequence[str] = ("product_name", "price")) -> DataFrame:
    return df.na.drop(how="any", subset=list(required))


def stage_feed(raw: DataFrame, feed: FeedSpec | str, **options) -> DataFrame:
    """Typed, de-duplicated, complete rows.

    De-duplication comes before dropping incomplete rows: if the first copy of a
    product has no price, the product is dropped although a later copy has one. It
    needs only the key texts, so copies go before any of their texts is parsed.
    """
    return drop_incomplete(to_typed(dedup_keep_first(raw, RAW_KEYS), feed, **options))


def union_feeds(*staged: DataFrame) -> DataFrame:
    """Feeds appended into one batch, matched by column name."""
    first, *others = staged
    for other in others:
        first = first.unionByName(other)
    return first
