"""Template boxes inside articles, pages without marks, broken pages."""

import time

import pytest

from shelfmark.llm import html_main


@pytest.mark.parametrize("marks", [html_main.BROADCAST_MARKS, 0])
def test_boxes_inside_articles(spark, marks):
    box = "<div class='x1'><p>Sign up</p><p>for letters</p></div>"

    def page(i):
        quote = "<div><p>shared quote</p></div>"
        body = [f"<p>own {i} {k}</p>" for k in range(16)]
        body.insert(i + 1, quote)  # at another place in every article
        return f"<body><{tag}><h1>T{i}</h1>{''.join(body)}<p>same words</p>{box}</{tag}></body>"

    rows = []
    for n, tag in enumerate(("article", "main")):
        rows += [(100 * n + i, f"http://{tag}.com/{i}", page(i)) for i in range(8)]
    copy = "<article><div><p>one article</p></div></article>"
    rows += [(300 + i, f"http://copies.com/{i}", copy) for i in range(8)]
    rows += [(400 + i, f"http://few.com/{i}", f"<article><p>own {i}</p>{box}</article>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_main.extract_main_text(df, broadcast_marks=marks).collect()}
    for i in range(8):
        want = [f"own {i} {k}" for k in range(16)]
        want.insert(i + 1, "shared quote")
        assert got[i] == got[100 + i] == "\n\n".join([f"T{i}", *want, "same words"])
    assert got[300] == "one article"
    assert got[400] == "own 0\n\nSign up\n\nfor letters"


def test_menu_of_one_section(spark):
    """A subtree on a small share of a host's pages is template, a repeat by chance is not."""
    def page(i):
        side = "<div><p>Section menu</p></div>" if i % 10 == 0 else ""
        chance = "<p>by chance</p>" if i in (1, 2, 3, 4) else ""
        return f"<body><div>{side}<p>own {i}</p>{chance}</div></body>"

    rows = [(i, f"http://large.com/{i}", page(i)) for i in range(200)]
    rows += [(1000 + i, None, "<body><div><p>menu</p></div><p>own</p></body>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_main.extract_main_text(df).collect()}
    assert len(got) == len(rows)
    assert [got[0], got[1], got[5], got[10]] == ["own 0", "own 1\n\nby chance", "own 5", "own 10"]
    assert got[1000] == "menu\n\nown"


def test_templates_alone_decide_where_nothing_is_marked(spark):
    """Shells without an article and with names that no list has."""
    shell = "<div class='q7'><ul><li>one</li><li>two</li></ul></div><div class='z1'>{}</div><div class='k3'><p>legal</p></div>"
    rows = [(i, f"http://plain.com/{i}", f"<body>{shell.format(f'<p>own {i}</p><p>more {i}</p>')}</body>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_main.extract_main_text(df).collect()}
    assert got == {i: f"own {i}\n\nmore {i}" for i in range(9)}
    without = {r.page_id: r.text for r in html_main.extract_main_text(df, min_pages=10).collect()}
    assert without[0] == "one\n\ntwo\n\nown 0\n\nmore 0\n\nlegal"


def test_stray_end_tags_take_linear_time():
    start = time.perf_counter()
    text = html_main.main_text("<i>" * 20_000 + "word" + "</b>" * 20_000, set())
    assert text == "word" and time.perf_counter() - start < 5
