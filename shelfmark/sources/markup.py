"""Patterns and column functions that read loose HTML with SQL functions only.

Regular expressions do not nest, so an element that may hold its own kind is cut by
:func:`element_body`, which counts opening and closing tags. All repetitions of groups
are possessive: Java runs those in a loop, so long texts cannot exhaust the stack.
"""

from __future__ import annotations

import html.entities
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that stand on a line of their own; a fixed list.
BLOCKS = "address|article|aside|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|section|table|td|th|tr|ul"
_BARE = sorted((name for name in html.entities.html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = rf"^(?:#([0-9]{{1,7}});?|#[xX]([0-9a-fA-F]{{1,6}});?|([A-Za-z][A-Za-z0-9]*);|({'|'.join(_BARE)}))"


def opening(tag: str, attr: str | None = None, value: str | None = None) -> str:
    """Pattern of an opening tag, with ``value`` among the words of ``attr`` if given."""
    if attr is None:
        return rf"<{tag}\b[^>]*+>"
    word = rf"(?<![\w-]){re.escape(value or '')}(?![\w-])"
    return rf"<{tag}\b[^>]*?\s{attr}\s*=\s*(?:\"[^\"]*?{word}[^\"]*+\"|'[^']*?{word}[^']*+'|{word})[^>]*+>"


def inner(tag: str) -> str:
    """Group of the content of ``tag``, up to the next tag of that name."""
    return rf"((?:[^<]++|<(?!/?{tag}\b))*+)"


def attribute(tag: str, attr: str) -> str:
    """Pattern of an opening tag whose group is the value of ``attr`` in double quotes."""
    return rf"<{tag}\b[^>]*?\s{attr}\s*=\s*\"([^\"]*+)\""


def readable(page: Column) -> Column:
    """The page without comments, scripts and styles, with all attribute values in double
    quotes where that is safe; a null page is empty."""
    page = F.regexp_replace(F.coalesce(page, F.lit("")), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    return F.regexp_replace(page, r"=\s*'([^'\"<>]*+)'(?=[^<>]*+>)", '="$1"')


#: Elements that may hold their own kind; a fixed list. Others end at the next tag of their name.
NESTING = set("article aside dd details div dl footer header li main nav ol section span table td th tr ul".split())
_INNER = re.compile(r"\(\(\?:\[\^<\]\+\+\|<\(\?!/\?(\w+)\\b\)\)\*\+\)$")


def _measured(rest: Column, tag: str) -> Column:
    """``parts`` of the text cut at the tags of a name, how many of them (``n``) lie in the
    element that ``rest`` begins in, and the ``depth`` at the end, 0 if it is closed."""
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))

    def step(state: Column, part: Column) -> Column:
        opened = F.when(part.rlike(rf"(?i)^<{tag}\b"), 1).when(part.rlike(rf"(?i)^</{tag}\b"), -1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + opened).otherwise(0)
        return F.struct(depth.alias("depth"), (state["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))

    parts = F.split(rest, rf"(?i)(?=</?{tag}\b)")
    # a list of one binds what is used several times, so that it is computed once
    counted = F.transform(F.array(parts), lambda p: F.struct(p.alias("parts"), F.aggregate(p, start, step).alias("end")))
    return F.transform(counted, lambda c: F.struct(c["parts"].alias("parts"), c["end"]["depth"].alias("depth"), c["end"]["n"].alias("n")))[0]


def _body(measured: Column) -> Column:
    return F.array_join(F.slice(measured["parts"], F.lit(1), measured["n"]), "")


def element_body(rest: Column, tag: str) -> Column:
    """What precedes the closing tag that belongs to an element of name ``tag``.

    ``rest`` begins behind the opening tag; an element that is never closed ends with it.
    """
    return F.transform(F.array(_measured(rest, tag)), _body)[0]


def bodies(page: Column, head: str, tag: str, unclosed: str | None = None) -> Column:
    """Contents of all elements of name ``tag`` whose opening tag ends a match of ``head``.

    An element goes to its own closing tag, whatever elements of its kind, also further
    matches, it holds; these stand in the list as well. An element that is never closed
    ends where the pattern ``unclosed`` does, else with the page.
    """
    cut = F.struct(F.split(page, head).alias("pieces"), F.regexp_extract_all(page, F.lit(head), F.lit(0)).alias("heads"))

    def each(s: Column) -> Column:
        def one(i: Column) -> Column:
            piece = F.element_at(s["pieces"], i + 1)
            later = F.zip_with(
                F.slice(s["heads"], i + 1, F.size(s["heads"])),
                F.slice(s["pieces"], i + 2, F.size(s["pieces"])),
                lambda head, text: F.concat(head, text),
            )
            whole = F.concat(piece, F.array_join(later, ""))

            def ended(m: Column) -> Column:
                open_end = F.regexp_extract(piece, f"(?s)^{unclosed}", 1) if unclosed else _body(m)
                return F.when(m["depth"] == 0, _body(m)).otherwise(open_end)

            # most elements end before the next match; only the others need all that follows
            own = F.array(_measured(piece, tag))
            return F.transform(
                own, lambda m: F.when(m["depth"] == 0, _body(m)).otherwise(F.transform(F.array(_measured(whole, tag)), ended)[0])
            )[0]

        return F.when(F.size(s["heads"]) > 0, F.transform(F.sequence(F.lit(1), F.size(s["heads"])), one)).otherwise(
            F.array().cast("array<string>")
        )

    return F.flatten(F.transform(F.array(cut), each))


def elements(page: Column, start: str) -> Column:
    """Contents of all elements whose opening tag matches ``start``, which begins with
    ``<`` and the tag's name."""
    tag = re.match(r"<(\w+)", start)
    if tag is None:
        raise ValueError("the pattern of an opening tag begins with < and a name")
    return bodies(page, f"(?i){start}", tag[1])


def value_element(selector: str) -> tuple[str, str] | None:
    """Pattern up to the value and the value's element, where a selector ends with the
    content of an element that may hold its own kind."""
    found = _INNER.search(selector)
    return (selector[: found.start()], found[1]) if found and found[1] in NESTING else None


def _character(code: Column) -> Column:
    """The character of a code point; no character gives the replacement character."""
    bad = (code < 1) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")


def decode_references(text: Column) -> Column:
    """Character references decoded once; named ones are those of HTML 4, and the old
    ones also count without a semicolon."""
    names = {name: chr(code) for name, code in html.entities.name2codepoint.items()} | {"apos": "'"}
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")  # a constant to the optimizer

    def decoded(piece: Column) -> Column:
        decimal, hexa, name, bare = (F.regexp_extract(piece, _REFERENCE, i) for i in range(1, 5))
        char = (
            F.when(decimal != "", _character(decimal.cast("long")))
            .when(hexa != "", _character(F.conv(hexa, 16, 10).cast("long")))
            .when(name != "", F.try_element_at(table, name))
            .when(bare != "", F.try_element_at(table, bare))
        )
        rest = F.regexp_replace(piece, _REFERENCE, "")
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    later = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(pieces[0], F.array_join(later, ""))).otherwise(text)


def shown_text(markup: Column) -> Column:
    """Text without tags, references decoded, white space runs as one space."""
    spaced = F.regexp_replace(markup, rf"(?i)</?(?:{BLOCKS})\b[^>]*+>", " ")
    plain = decode_references(F.regexp_replace(spaced, r"</?[A-Za-z][^>]*+>", ""))
    return F.trim(F.regexp_replace(plain, r"[ \t\n\f\r]+", " "))


def absolute(href: Column, url: Column) -> Column:
    """``href`` as seen from the page at ``url``; dot segments stay as they are."""
    page = F.coalesce(url, F.lit(""))
    origin = F.regexp_extract(page, r"^[A-Za-z][\w+.-]*://[^/?#]*+", 0)
    bare = F.regexp_extract(page, r"^[^?#]*+", 0)
    folder = F.regexp_extract(bare, r"^[A-Za-z][\w+.-]*://[^/]*+/(?:.*/)?", 0)
    return (
        F.when(href.rlike(r"^[A-Za-z][\w+.-]*:") | (origin == ""), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page, r"^[^:]*+:", 0), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href == "", page)
        .when(href.startswith("#"), F.concat(F.regexp_extract(page, r"^[^#]*+", 0), href))
        .when(href.startswith("?"), F.concat(bare, href))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), href))
    )
