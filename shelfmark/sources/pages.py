"""Raw product pages: field extraction, links, and page fragments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.images import JOINER
from shelfmark.sources import markup
from shelfmark.sources.spec import header


def _found(part: Column, kind: str, selector: str) -> Column:
    """Values, or pairs of label text and value, in one part of a page."""
    pattern, group = F.lit(f"(?s){selector}"), 1 if kind == "value" else 2
    values = F.regexp_extract_all(part, pattern, F.lit(group))
    if nested := markup.value_element(selector):
        head, tag = nested
        pattern = F.lit(f"(?s){head}")
        values = markup.bodies(part, f"(?s){head}", tag, markup.inner(tag))
    if kind == "value":
        return values
    labels = F.transform(F.regexp_extract_all(part, pattern, F.lit(1)), markup.shown_text)
    return F.arrays_zip(labels.alias("label"), values.alias("value"))


def _hits(found: Column, rule: dict[str, str]) -> Column:
    if rule["type"] == "pair":
        found = F.transform(F.filter(found, lambda p: p["label"].rlike(rule["label"])), lambda p: p["value"])
    return F.slice(found, 1, 1) if rule["number"] == "first" else found


def extract_fields(
    pages: DataFrame, fields: Sequence[dict[str, str]], keep: Sequence[str] = ("page_id", "url"), html: str = "html"
) -> DataFrame:
    """One text column per field of the specification, next to the ``keep`` columns.

    A rule of type ``value`` takes group 1 of its pattern, a ``pair`` takes group 2 where
    the text of group 1 matches its label; with ``within`` only inside the elements that
    begin with that tag. Several rules of one field add up. A field without a hit is an
    empty text, several hits are joined by ``', '``. Native functions and no shuffle; each
    element and each pattern is looked for once, however many fields use it.
    """
    if bad := {f["type"] for f in fields} - {"value", "pair"}:
        raise ValueError(f"a rule is a value or a pair, not {bad.pop()}")
    kept = [F.col(f"`{k}`") for k in keep]
    scopes = list(dict.fromkeys(f.get("within") for f in fields))
    places = list(dict.fromkeys((f.get("within"), f["type"], f["selector"]) for f in fields))

    def look(place: tuple[str | None, str, str]) -> Column:
        within, kind, selector = place
        parts = F.col(f"_scope{scopes.index(within)}")
        return F.flatten(F.transform(parts, lambda part: _found(part, kind, selector)))

    def rows(attrs_are_text: bool, name: str) -> Column:
        rules = [f for f in fields if f["field_name"] == name and (f["attr"] == "text") == attrs_are_text]
        hits = [_hits(F.col(f"_at{places.index((r.get('within'), r['type'], r['selector']))}"), r) for r in rules]
        return F.concat(*hits) if hits else F.array().cast("array<string>")

    names = header(fields)
    page = F.col("_page")
    read = pages.select(*kept, markup.readable(F.col(html)).alias("_page"))
    read = read.select(*kept, *[(markup.elements(page, w) if w else F.array(page)).alias(f"_scope{i}") for i, w in enumerate(scopes)])
    read = read.select(*kept, *[look(place).alias(f"_at{i}") for i, place in enumerate(places)])
    read = read.select(
        *kept,
        F.transform(F.array(*[rows(True, n) for n in names]), lambda hits: F.transform(hits, markup.shown_text)).alias("_texts"),
        F.transform(F.array(*[rows(False, n) for n in names]), lambda hits: F.transform(hits, markup.decode_references)).alias(
            "_attrs"
        ),
    )
    both = [F.concat(F.col("_texts")[i], F.col("_attrs")[i]) for i in range(len(names))]
    return read.select(*kept, *[F.array_join(hits, JOINER).alias(name) for hits, name in zip(both, names)])


def _link_rows(pages: DataFrame, hrefs: Column, keep: Sequence[str], url: str) -> DataFrame:
    linked = pages.select(*keep, F.col(url).alias("_url"), F.posexplode(F.filter(hrefs, lambda h: h != "")).alias("_pos", "_href"))
    href = markup.absolute(F.trim(markup.decode_references(F.col("_href"))), F.col("_url"))
    return linked.select(*keep, (F.col("_pos") + 1).alias("n"), href.alias("href"))


def _first_href(block: Column) -> Column:
    return F.regexp_extract(block, f"(?s){markup.attribute('a', 'href')}", 1)


def extract_links(
    pages: DataFrame, block: str, keep: Sequence[str] = ("page_id",), url: str = "url", html: str = "html"
) -> DataFrame:
    """One row per product link: the first ``href`` inside each match of ``block``.

    ``block`` is a regex for one product block of a listing page. Addresses are decoded
    and made absolute with the page's own; ``n`` is the place of the link on the page.
    """
    blocks = F.regexp_extract_all(markup.readable(F.col(html)), F.lit(f"(?s){block}"), F.lit(0))
    return _link_rows(pages, F.transform(blocks, _first_href), keep, url)


def listing_links(
    pages: DataFrame,
    block: str,
    within: str | None = None,
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Like :func:`extract_links` for blocks that nest: ``block`` is the pattern of the
    opening tag of a product block, ``within`` that of the elements to look in."""
    page = markup.readable(F.col(html))
    blocks = markup.elements(page, block)
    if within:
        blocks = F.flatten(F.transform(markup.elements(page, within), lambda part: markup.elements(part, block)))
    return _link_rows(pages, F.transform(blocks, _first_href), keep, url)


def absolutize_urls(html: Column, url: Column, attrs: Sequence[str] = ("src", "data-image")) -> Column:
    """Give ``//host`` addresses in the named attributes the protocol of the page."""
    protocol = F.when(url.startswith("https"), "https:").otherwise("http:")
    for attr in attrs:
        html = F.replace(html, F.lit(f'{attr}="//'), F.concat(F.lit(f'{attr}="'), protocol, F.lit("//")))
    return html


def compose_fragments(
    pages: DataFrame,
    section: str,
    blocks: Sequence[tuple[str, str | None]],
    keep: Sequence[str] = ("page_id", "url"),
    html: str = "html",
) -> DataFrame:
    """Cut the wanted blocks out of a page and wrap them in one ``<section>``.

    ``blocks`` lists (regex, id of an inner section or ``None``); a block that the
    page does not have is an empty text.
    """
    parts: list[Column] = []
    for pattern, inner in blocks:
        found = F.coalesce(F.regexp_extract(F.col(html), f"(?s){pattern}", 0), F.lit(""))
        parts.append(F.concat(F.lit(f'<section id="{inner}">'), found, F.lit("</section>")) if inner else found)
    body = F.concat_ws("\n", *parts)
    whole = F.concat(F.lit(f'<section id="{section}">\n'), body, F.lit("\n</section>"))
    return pages.select(*keep, whole.alias("fragment"))
