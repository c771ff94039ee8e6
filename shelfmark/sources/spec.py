"""Field specifications: which element of a page becomes which column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.markup import attribute, inner, opening

SPEC_SCHEMA = (
    "instance string, crawler string, extractor string,"
    " fields array<struct<field_name string, number string, attr string, type string, selector string,"
    " within string, label string>>"
)


class BadSpec(ValueError):
    """The text is not a field specification."""


def spec_from_json(text: Column, schema: str = SPEC_SCHEMA) -> Column:
    """JSON text to a struct; malformed text gives NULL."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def read_spec(spark: SparkSession, text: str) -> list[dict[str, str]]:
    """The fields of one specification, on the driver; malformed text raises."""
    row = spark.range(1).select(spec_from_json(F.lit(text)).alias("spec")).first()
    if row["spec"] is None or not row["spec"]["fields"]:
        raise BadSpec("not a field specification")
    return [field.asDict() for field in row["spec"]["fields"]]


def header(fields: Sequence[dict[str, str]]) -> list[str]:
    """CSV header of a specification: its field names in the order of their first rules."""
    return list(dict.fromkeys(field["field_name"] for field in fields))


def rule(
    name: str,
    selector: str,
    attr: str = "text",
    within: str | None = None,
    label: str | None = None,
    number: str = "single",
) -> dict[str, str | None]:
    """One rule of a field; with a ``label`` the selector has a group for it and one for the value."""
    kind = "value" if label is None else "pair"
    return {
        "field_name": name, "number": number, "attr": attr, "type": kind,
        "selector": selector, "within": within, "label": label,
    }


# The labels next to the attribute values on the pages of the two
# feeds, and where name, price and images stand.
LABELS_A = {
    "weight": "Trọng lượng",
    "size": "Kích thước",
    "dpi": "Độ phân giải",
    "sensor": "Cảm biến",
    "connector": "Kết nối",
    "pin": "Pin",
    "os": "Tương thích",
    "brand": "Hãng sản xuất",
}
LABELS_B = {
    "weight": ("trọng lượng",),
    "brand": ("hãng sản xuất", "thương hiệu"),
    "dpi": ("dpi", "phân giải"),
    "size": ("kích thước",),
    "sensor": ("cảm biến",),
    "connector": ("kết nối",),
    "os": ("tương thích",),
    "pin": ("pin", "dung lượng"),
}
HEADING = opening("h1") + inner("h1")
NAME_A, NAME_B = opening("div", "class", "box-product-name"), opening("div", "class", "product-name")
PRICE_A = opening("p", "class", "product__price--show") + inner("p")
PRICE_B = opening("span", "class", "pro-price") + inner("span")
GALLERY = opening("div", "class", "swiper-wrapper")
IMAGES_A, IMAGES_B = attribute("img", "src"), attribute("a", "data-image")
# listing pages: opening tags of the product blocks, and of what they stand in
LISTING_A = (opening("div", "class", "product-info"), None)
LISTING_B = (opening("p", "class", "proloop-img"), opening("div", "class", "collection-product"))


def feed_a_spec() -> list[dict[str, str | None]]:
    """An attribute is the ``div`` after the ``p`` that holds its label."""
    pair = opening("p") + r"([^<]*+)</p\s*>\s*" + opening("div") + inner("div")
    labelled = [rule(name, pair, label=f"^{re.escape(label)}$") for name, label in LABELS_A.items()]
    return labelled + [
        rule("name", HEADING, within=NAME_A),
        rule("price", PRICE_A),
        rule("images", IMAGES_A, "src", GALLERY, number="multiple"),
    ]


def _cells(tag: str, parent: str) -> str:
    """The first two cells of a row."""
    cell = opening(tag) + inner(tag)
    return rf"{opening(parent)}\s*{cell}</{tag}\s*>\s*{cell}"


def feed_b_spec() -> list[dict[str, str | None]]:
    """An attribute is the second cell of the row, or second ``div`` of the list
    entry, whose first holds one of its labels in any ASCII case."""
    places = (
        (opening("section", "id", "table-2"), _cells("td", "tr")),
        (opening("section", "id", "table-1"), _cells("div", "li")),
    )
    labelled = [
        rule(name, cells, within=section, label=f"(?i){'|'.join(map(re.escape, labels))}")
        for name, labels in LABELS_B.items()
        for section, cells in places
    ]
    return labelled + [
        rule("images", IMAGES_B, "data-image", GALLERY, number="multiple"),
        rule("name", HEADING, within=NAME_B),
        rule("price", PRICE_B),
    ]
