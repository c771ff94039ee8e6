"""Main text of web pages: template subtrees of a host removed, then the article.

A small parser turns a page into nested elements and hashes every subtree (tag and
content). Spark counts, per host, on how many pages each subtree stands; those on many
pages are the host's template and are deleted, together with elements that are never main
text by their tag or class (menus, footers, scripts, forms, adverts, comments, ...). Of
what is left, the article is the text; without an article element it is the rest of the
body.

Inside an article only boxes (``BOXES``) count, each with its parent's tag and its place
from the parent's start or end, so a box of the layout is deleted and a passage stays that
many articles share as paragraphs or at different places. An article that would have no
text left, as many copies of one article, keeps its boxes.

Blocks are paragraphs, headings, list items, table cells and the like; a line break
is white space within a block.

Defined results: null or empty HTML gives an empty text; broken markup is read as far as
it goes; a null host or URL is a host of its own; repeated pages count as pages; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import settle, ship_package
from shelfmark.llm.urls import url_host

#: A subtree is template from this many pages of a host on ...
MIN_PAGES = 5
#: ... that are this share of the host's pages, so that chance repeats on a large host stay.
MIN_SHARE = 0.01
#: Recurring subtrees that are broadcast at most, eight bytes each.
BROADCAST_MARKS = 2_000_000

# Names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr "
    "html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS | set("aside footer form header nav".split())
NEVER = set(
    "head script style noscript template nav footer aside form iframe object svg canvas button select textarea input "
    "menu dialog audio video".split()
)
#: Words of class, id or role that mark what is not main text.
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|breadcrumb|breadcrumbs|comment|comments|cookie|cookies|consent|"
    r"disqus|footer|menu|nav|navbar|navigation|newsletter|notice|notices|popup|promo|related|replies|responses|"
    r"share|sharing|sidebar|social|sponsor|sponsored|subscribe)(?:$|[\s_-])",
    re.I,
)
SPACE = re.compile(r"\s+")
#: Elements that may be template inside an article: containers, not blocks of text.
BOXES = set("details div dl figure ol section table ul".split())


class Node:
    __slots__ = ("tag", "mark", "parts")

    def __init__(self, tag: str, mark: str = "") -> None:
        self.tag, self.mark = tag, mark
        self.parts: list[Node | str] = []


class _Tree(HTMLParser):
    """Nested elements; an end tag closes the nearest open element of its name."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.counts: dict[str, int] = {}  # of open elements by name

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_P:
            self._close("p", {"article", "main", "section", "div", "td", "li", "blockquote"})
        if tag in ("li", "tr", "td", "th", "dt", "dd"):
            self._close(tag, {"ul", "ol", "table", "dl"})
        mark = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        node = Node(tag, mark)
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def _close(self, tag: str, scope: set[str]) -> None:
        if not self.counts.get(tag):
            return  # a stray end tag does not walk the open elements
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                for node in self.open[i:]:
                    self.counts[node.tag] -= 1
                del self.open[i:]
                return
            if self.open[i].tag in scope:
                return

    def handle_endtag(self, tag: str) -> None:
        self._close(tag, set())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main")


def _elements(root: Node) -> list[tuple[Node, Node, bool]]:
    """Every element with its parent, parents first, and whether it is inside an article."""
    out: list[tuple[Node, Node, bool]] = []
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or _is_article(node)
        for part in node.parts:
            if isinstance(part, Node):
                out.append((part, node, inside))
                todo.append((part, inside))
    return out


def subtree_hashes(root: Node) -> dict[int, tuple[str, ...]]:
    """Hashes of each subtree that holds no article, by the node's ``id``: one outside an
    article, inside one those of a box at its place from the start and from the end."""
    holds: set[int] = set()
    hashes: dict[int, str] = {}
    order = _elements(root)
    for node, parent, _ in reversed(order):
        if _is_article(node) or id(node) in holds:
            holds.add(id(parent))
            continue
        parts = [node.tag, *(SPACE.sub(" ", p) if isinstance(p, str) else hashes.get(id(p), "") for p in node.parts)]
        content = "\0".join(parts).encode("utf-8", "surrogatepass")
        hashes[id(node)] = hashlib.blake2b(content, digest_size=8).hexdigest()
    places: dict[int, tuple[int, int]] = {}
    for node in {id(p): p for _, p, inside in order if inside}.values():
        children = [part for part in node.parts if isinstance(part, Node)]
        places |= {id(c): (k, k - len(children)) for k, c in enumerate(children)}
    out: dict[int, tuple[str, ...]] = {}
    for node, parent, inside in order:
        if id(node) not in hashes:
            continue
        if not inside:
            out[id(node)] = (hashes[id(node)],)
        elif node.tag in BOXES:
            out[id(node)] = tuple(f"{hashes[id(node)]} {parent.tag} {place}" for place in places[id(node)])
    return out


def _blocks(node: Node, dropped: set[int]) -> list[str]:
    """Texts of the blocks under ``node``, in order, white space made one space."""
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(held)).strip()
        if text:
            blocks.append(text)
        held.clear()

    todo: list[tuple[Node | str, bool]] = [(node, True)]
    while todo:
        part, starts = todo.pop()
        if isinstance(part, str):
            held.append(part)
        elif not starts:
            flush()
        elif part.tag == "br":
            held.append(" ")
        elif id(part) not in dropped:
            if part.tag in BLOCKS or part.tag == "header":
                flush()
                todo.append((part, False))
            todo.extend((p, True) for p in reversed(part.parts))
    flush()
    return blocks


def main_text(html: str | None, template: set[str]) -> str:
    """Text of one page; ``template`` holds the hashes of its host's recurring subtrees."""
    root = parse(html)
    return _text(root, subtree_hashes(root), template)


def _text(root: Node, hashes: dict[int, tuple[str, ...]], template: set[str]) -> str:
    dropped: set[int] = set()
    boxes: set[int] = set()
    articles: list[Node] = []
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if _is_article(node) and not inside:
            articles.append(node)
            inside = True
        for part in reversed(node.parts):
            if not isinstance(part, Node):
                continue
            marked = part.tag not in ("html", "body", "main") and bool(part.mark) and NOT_MAIN.search(part.mark)
            never = part.tag in NEVER or marked
            recurs = not template.isdisjoint(hashes.get(id(part), ()))
            if not inside and part.tag != "article":
                # what still holds an article, as unclosed markup may, is gone through
                never = id(part) in hashes and (never or part.tag == "header" or recurs)
            elif inside and recurs:
                boxes.add(id(part))
            if never:
                dropped.add(id(part))
            else:
                todo.append((part, inside))
    if not articles:
        return "\n\n".join(_blocks(root, dropped))
    texts = (_blocks(node, dropped | boxes) or _blocks(node, dropped) for node in articles)
    return "\n\n".join(block for blocks in texts for block in blocks)


def countable(root: Node, hashes: dict[int, tuple[str, ...]]) -> list[str]:
    """Distinct hashes of the subtrees of one page that are neither void nor never text."""
    found = (n for n, _, _ in _elements(root) if id(n) in hashes and n.parts and n.tag not in NEVER)
    return sorted({h for n in found for h in hashes[id(n)]})


def page_subtrees(html: str | None) -> list[str]:
    root = parse(html)
    return countable(root, subtree_hashes(root))


def marks(host: str | None, subtrees: Collection[str]) -> np.ndarray:
    """The subtrees of a host's page as 64-bit numbers."""
    site = hashlib.blake2b((host or "").encode("utf-8", "surrogatepass"), digest_size=8)
    out = np.empty(len(subtrees), dtype=np.int64)
    for i, subtree in enumerate(subtrees):
        one = site.copy()
        one.update(subtree.encode())
        out[i] = int.from_bytes(one.digest(), "little", signed=True)
    return out


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.iloc[start : start + 500]
            found = [marks(host, page_subtrees(html)) for host, html in zip(part["host"], part["html"])]
            sizes = [len(x) for x in found]
            rest = {c: part[c].repeat(sizes) for c in part.columns if c != "html"}
            yield pd.DataFrame({**rest, "mark": np.concatenate(found)})


def recurring_subtrees(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``mark`` of the subtrees that are on enough pages of their host (``host``, ``html``).

    Counts combine on the map side, so a host with a third of all pages sends one row per
    subtree and task; neither pages nor their subtrees are written.
    """
    counts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    subtrees = pages.select("host", "html").mapInPandas(_subtrees, "host string, mark long")
    # the number has its host in it
    on = subtrees.groupBy("mark").agg(F.count("*").alias("on"), F.first("host").alias("host")).where(F.col("on") >= min_pages)
    counted = on.join(counts, on["host"].eqNullSafe(counts["host"]))
    return counted.where(F.col("on") >= F.col("pages") * min_share).select("mark")


def _extract(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start : start + 500]
                lists = [None] * len(part) if shared else part["template"]
                texts = []
                for html, host, own in zip(part["html"], part["host"], lists):
                    known = shared.value if shared else np.sort(np.asarray(own if own is not None else [], dtype=np.int64))
                    root = parse(html)
                    hashes = subtree_hashes(root)
                    names = countable(root, hashes)
                    numbers = marks(host, names)
                    at = np.searchsorted(known, numbers)
                    hit = np.zeros(len(numbers), dtype=bool)
                    inside = at < len(known)
                    hit[inside] = known[at[inside]] == numbers[inside]
                    texts.append(_text(root, hashes, {names[i] for i in np.flatnonzero(hit)}))
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts})

    return run


def extract_main_text(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    broadcast_marks: int = BROADCAST_MARKS,
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page.

    Pages are read twice, to count and to extract; up to ``broadcast_marks`` recurring
    subtrees (eight bytes each) are broadcast, so that no page is written or shuffled.
    Beyond that every page is joined with its own recurring subtrees.
    """
    ship_package(pages.sparkSession)
    kind = dict(pages.select(F.col(page_id).alias("p")).dtypes)["p"]
    hosted = pages.select(
        F.col(page_id).cast("string").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
        url_host(F.col(url)).alias("host"),
    )
    recurring = settle(recurring_subtrees(hosted, min_pages, min_share), "recurring")
    columns = ["page_id", "url", "html", "host"]
    schema = "page_id string, url string, text string"
    if recurring.count() <= broadcast_marks:
        known = np.sort(np.array([r["mark"] for r in recurring.collect()], dtype=np.int64))
        shared = pages.sparkSession.sparkContext.broadcast(known)
        texts = hosted.select(*columns).mapInPandas(_extract(shared), schema)
    else:
        numbered = settle(hosted.withColumn("row", F.monotonically_increasing_id()), "pages")
        found = numbered.select("row", "host", "html").mapInPandas(_subtrees, "row long, host string, mark long")
        templates = found.join(recurring, "mark", "left_semi").groupBy("row").agg(F.collect_list("mark").alias("template"))
        texts = numbered.join(templates, "row", "left").select(*columns, "template").mapInPandas(_extract(None), schema)
    return texts.select(F.col("page_id").cast(kind).alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
