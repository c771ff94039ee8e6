"""Image lists: one comma-joined string of URLs per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marker before the real URL and the joiner.
MARKER = "plain/"
JOINER = ", "


def image_list(images: Column) -> Column:
    """Every URL of the list cut to the part after the last ``plain/``."""
    urls = F.split(images, ",")
    return F.array_join(F.transform(urls, lambda url: F.trim(F.substring_index(url, MARKER, -1))), JOINER)


def split_images(df: DataFrame, images: str = "images") -> DataFrame:
    """One row per listed URL with its place ``n`` in the list."""
    keep = [c for c in df.columns if c != images]
    exploded = df.select(*keep, F.posexplode(F.split(F.col(images), ",")).alias("_pos", "_url"))
    return exploded.select(*keep, (F.col("_pos") + 1).alias("n"), F.trim("_url").alias("url"))
