"""CSV files, pages, specifications, and the file-to-mart pipeline."""

import csv
import json
import os
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import calendar, checks, control, history
from shelfmark.operators.control import AlreadyRun, MissingInput
from shelfmark.plans import derived as D
from shelfmark.plans import pipeline, warehouse
from shelfmark.plans.pipeline import ExportFailed, FeedPaths, LoadFailed, load_feeds, pages_to_csv, run_feed_files
from shelfmark.schemas import DIMENSION_SCHEMA, FEED_A_FIELDS, FEED_B_FIELDS, KEYS, LOG_SCHEMA
from shelfmark.sources import csv_feed, markup, pages, spec, tables
from shelfmark.sources.versions import Conflict

TRICKY = [("1", 'say "hi"', "a,b"), ("2", "", "x\\y"), ("3", "ế", " sp "), ("4", "\\N", "end")]


def test_columns_come_from_the_config():
    assert csv_feed.map_columns("weight, size,dpi ,  os".replace(" ,", ",")) == ["weight", "size", "dpi", "os"]
    assert sorted(FEED_A_FIELDS) == sorted(FEED_B_FIELDS) and FEED_A_FIELDS != FEED_B_FIELDS


def test_roundtrip_of_tricky_texts(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, "k string, a string, b string").coalesce(1)
    path = str(tmp_path / "out")
    assert csv_feed.export_csv(df, path) == 4
    back = csv_feed.load_csv(spark, path, {"staging_fields": "k, a, b", "ignore_rows": 1}).orderBy("id").collect()
    want = [(i + 1, *row) for i, row in enumerate(TRICKY)]
    assert [tuple(r) for r in back] == want


def test_roundtrip_keeps_every_record_on_one_line(spark, tmp_path):
    texts = ["a\nb", "a\r\nb", '"', '""', "\\", "\\\\n", "\\n", "\\N", "\t,\0", "", None, 'x"\ny\\']
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, a string").coalesce(1)
    path = str(tmp_path / "out")
    assert csv_feed.export_csv(df, path) == len(texts)
    (part,) = (tmp_path / "out").glob("part-*")
    assert len(part.read_bytes().split(b"\n")) == len(texts) + 2
    back = csv_feed.load_csv(spark, path, {"staging_fields": "k, a"}).orderBy("id").collect()
    assert [(r.k, r.a) for r in back] == [(str(i), t) for i, t in enumerate(texts)]


def test_file_stats_counts_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n")
    (tmp_path / "b.csv").write_text("k\n1\n2\n")
    read = csv_feed.load_csv(spark, str(tmp_path), {"staging_fields": "k"}, numbered=False)
    assert tuple(csv_feed.file_stats(read, str(tmp_path)).first()) == (2, 2, 8, 1)


@pytest.mark.parametrize(("skip", "small"), [(0, True), (1, True), (3, True), (3, False)])
def test_rows_are_numbered_in_file_order_over_blocks(spark, tmp_path, monkeypatch, skip, small):
    """Also where the table of blocks is too large for a broadcast."""
    monkeypatch.setattr(csv_feed, "fits", lambda df: small)
    lines = [f"skip;{i}" for i in range(skip)] + [f"{i};text {i}" for i in range(3000)]
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    config = {"staging_fields": "n, t", "fields_terminated_by": ";", "lines_terminated_by": "\\n", "ignore_rows": skip}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.minPartitionNum", "16")
    try:
        loaded = csv_feed.load_csv(spark, str(tmp_path), config)
        rows = loaded.orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert [r.id for r in rows] == list(range(1, 6001))
    assert [int(r.n) for r in rows] == [*range(3000), *range(3000)]


def test_file_stats(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    path = str(tmp_path / "out")
    written = csv_feed.export_csv(df, path)
    read = csv_feed.load_csv(spark, path, {"staging_fields": "k"}, numbered=False)
    row = csv_feed.file_stats(read, path).first()
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("part-*"))
    assert (row["rows"], row["bytes"], row["size_kb"]) == (written, size, -(-size // 1024))


def test_date_dim_csv(spark, tmp_path):
    cal = calendar.date_dim(spark, "2024-01-01", "2024-03-01")
    cal.write.options(header="false", quoteAll="true").csv(str(tmp_path / "cal"))
    back = csv_feed.load_date_dim(spark, str(tmp_path / "cal"))
    assert back.exceptAll(cal).isEmpty() and back.count() == 61
    copied = tables.copy_table(spark, tables.reload(back, str(tmp_path / "a")) and str(tmp_path / "a"), str(tmp_path / "b"))
    assert copied.count() == 61
    assert tables.append(cal, str(tmp_path / "b")).count() == 122


# --- pages -----------------------------------------------------------------------

PAGE_A = """<div class="box-product-name big"><h1> Chuột  <b>X1</b> </h1></div>
<p class=product__price--show>269.100đ</p>
<ul><li><p>Trọng lượng</p><div>58 g</div><div>other</div><li><p>Pin</p> <div>1 x<br>AA &amp; dây</div></ul>
<div class="swiper-wrapper"><img src="a.png"><div><img src='b.png'/></div></div><img src="c.png">"""
PAGE_B = """<section id="table-1"><ul><li><div>Kết Nối</div><div>USB</div></li><li><div>DPI tối đa</div><div>8000</div></li></ul></section>
<section id="table-2"><table><tr><td>Thương hiệu</td><td>Acme</td></tr><tr><td>TRọng lượng</td><td> 60 g </td></tr>
<tr><td><b>Kích thước</b></td><td>1 x 2 x 3 mm</td></tr></table></section>
<div class="product-name"><h1>B2</h1></div><span class="pro-price a">1.290.000₫</span>
<div class="swiper-wrapper"><a class="product-gallery--photo" data-image="//i/1.png"></a><a class="x product-gallery--photo" data-image="//i/2.png"></a></div>"""


def test_extract_fields_of_both_feeds(spark):
    df = spark.createDataFrame([(1, PAGE_A, "a"), (2, None, "b")], "page_id int, html string, url string")
    a, empty = pages.extract_fields(df, spec.feed_a_spec()).orderBy("page_id").collect()
    assert (a.weight, a.pin, a.name, a.price) == ("58 g", "1 x AA & dây", "Chuột X1", "269.100đ")
    assert (a.images, a.size, a.brand) == ("a.png, b.png", "", "")
    assert empty.weight == "" and spec.header(spec.feed_a_spec()) == list(FEED_A_FIELDS)
    df = spark.createDataFrame([(1, PAGE_B)], "page_id int, html string")
    b = pages.extract_fields(df, spec.feed_b_spec(), keep=["page_id"]).first()
    assert (b.connector, b.dpi, b.brand, b.weight, b.size) == ("USB", "8000", "Acme", "60 g", "1 x 2 x 3 mm")
    assert (b.name, b.price, b.images, b.sensor) == ("B2", "1.290.000₫", "//i/1.png, //i/2.png", "")
    assert spec.header(spec.feed_b_spec()) == list(FEED_B_FIELDS)


def _values(spark, column, *rows):
    """``column`` over one-column rows."""
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], "t string").select(column).collect()]


def test_values_hold_elements_of_their_kind(spark):
    page = (
        "<p>Pin</p><div>AA <div>x2</div> pcs</div><p>Cảm biến</p><div><div>Logi</div></div>"
        "<div class='box-product-name'><h1>N</h1></div><p>Kết nối</p><div>open <b>end</b>"
    )
    df = spark.createDataFrame([(page,)], "html string")
    row = pages.extract_fields(df, spec.feed_a_spec(), keep=[]).first()
    assert (row.pin, row.sensor, row.name, row.connector) == ("AA x2 pcs", "Logi", "N", "open end")
    outer = "<div class='x'>a<div class='x'>b</div>c</div><div class='x'>d"
    got = spark.createDataFrame([(outer,)], "html string").select(markup.elements(F.col("html"), "<div\\b[^>]*>")).first()[0]
    assert got == ["a<div class='x'>b</div>c", "b", "d"]
    table = "<section id='table-2'><tr><td>DPI</td><td>one <table><tr><td>800</td></tr></table> two</td></tr></section>"
    row = pages.extract_fields(spark.createDataFrame([(table,)], "html string"), spec.feed_b_spec(), keep=[]).first()
    assert row.dpi == "one 800 two"


def test_elements_nest(spark):
    got = _values(
        spark,
        markup.elements(F.col("t"), markup.opening("div", "class", "x")),
        "<div class='y x'><div>1</div>2</div>3",
        '<div class=x>a<p>b<DIV id=1>c',
        '<div class="xy">a</div>',
        "",
        '<div class="x">' + "<div>" * 3000 + "</div>" * 3000 + "k</div>no",
    )
    assert got[:4] == [["<div>1</div>2"], ["a<p>b<DIV id=1>c"], [], []]
    assert len(got[4][0]) == 3000 * 11 + 1


def test_shown_text_and_references(spark):
    texts = [
        ("a &amp;amp; b", "a &amp; b"), ("&#233;&#xE9;&eacute;&copy 1", "ééé© 1"), ("&nope; & &#; &", "&nope; & &#; &"),
        ("&#0;&#xD800;&#9999999;", "\ufffd" * 3), ("<p>a<br>b</p><b>c</b>d < e", "a b cd < e"), ("", ""), (None, None),
        ("&#128512;", "\U0001f600"), ("x" * 200_000 + "&lt;", "x" * 200_000 + "<"),
    ]
    assert _values(spark, markup.shown_text(F.col("t")), *[t for t, _ in texts]) == [want for _, want in texts]


def test_absolute_addresses(spark):
    page = "https://h.x/a/b?q=1/2#f"
    for href in ("/1", "c", "//o/1", "http://o/2", "?z", "#g", "", "c/d?e"):
        assert _values(spark, markup.absolute(F.col("t"), F.lit(page)), href) == [urljoin(page, href)], href
    assert _values(spark, markup.absolute(F.col("t"), F.lit("http://h.x")), "c") == ["http://h.x/c"]
    assert _values(spark, markup.absolute(F.col("t"), F.lit(None).cast("string")), "c") == ["c"]


def test_broken_markup_is_read_somehow(spark):
    rng = random.Random(1)
    pieces = ["<", ">", "<![", "foo", "[", "if", "]]>", "<!", "--", "<!--", "-->", "<p", "/", "</p>", "a=", '"', "'", " "]
    pieces += ["&", "&#", "&#x", "&amp", "<?", "<script>", "</script", "\n", "\x00", "<style>", "é", "<li>", "</li>"]
    texts = [(i, "".join(rng.choices(pieces, k=rng.randrange(1, 12))), None) for i in range(5000)]
    df = spark.createDataFrame(texts, "page_id int, html string, url string")
    assert pages.extract_fields(df, spec.feed_a_spec()).count() == 5000
    long = spark.createDataFrame([(1, "<div>" + "a<b>" * 200_000 + "</div>" + "<p>x</p><div>" * 2000, "u")], df.schema)
    assert len(pages.extract_fields(long, spec.feed_b_spec()).collect()) == 1


def test_extraction_is_native(spark):
    df = spark.createDataFrame([(1, PAGE_A, "a")], "page_id int, html string, url string")
    plan = pages.extract_fields(df, spec.feed_a_spec())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "Exchange" not in plan
    with pytest.raises(ValueError, match="value or a pair"):
        pages.extract_fields(df, [dict(spec.feed_a_spec()[0], type="css")])


def test_links_fragments_and_urls(spark):
    html = '<div class="p"><a href="/1">a</a><a href="/2">b</a></div><div class="p"><i></i></div><div class="p"><a x=1 href="/3">c</a></div>'
    df = spark.createDataFrame([(1, "https://s/x", html), (2, "http://s/y", None)], "page_id int, url string, html string")
    links = pages.extract_links(df, '<div class="p">.*?</div>').collect()
    assert [(r.page_id, r.n, r.href) for r in links] == [(1, 1, "https://s/1"), (1, 2, "https://s/3")]
    rows = pages.compose_fragments(df, "s", [("<i>.*?</i>", None), ("<table>", "t")]).orderBy("page_id").collect()
    assert rows[0].fragment == '<section id="s">\n<i></i>\n<section id="t"></section>\n</section>'
    assert rows[1].fragment == '<section id="s">\n\n<section id="t"></section>\n</section>'
    text = spark.createDataFrame([("https://x",), ("http://x",)], "url string").select(
        pages.absolutize_urls(F.lit('<img src="//i/a" data-image="//i/b" alt="//c">'), F.col("url"))
    )
    assert [r[0] for r in text.collect()] == [
        f'<img src="{p}://i/a" data-image="{p}://i/b" alt="//c">' for p in ("https", "http")
    ]


def test_listing_links(spark):
    a = '<div class="product-info"><div><a>x</a><a href="/1.html">1</a></div><a href="/2">2</a></div><div class="product-info"></div>'
    a += '<div class="product-info big"><a href="https://other/3">3</a></div><a href="/4">4</a>'
    b = '<div class="collection-product"><div class="loaded"><p class="proloop-img"><a href="//h/5"></a></p><a href="6"></a></div></div>'
    df = spark.createDataFrame([(1, "https://s/list/x", a), (2, None, None)], "page_id int, url string, html string")
    rows = pages.listing_links(df, *spec.LISTING_A).orderBy("n").collect()
    assert [(r.page_id, r.n, r.href) for r in rows] == [(1, 1, "https://s/1.html"), (1, 2, "https://other/3")]
    df = spark.createDataFrame([(1, "http://s/", b)], "page_id int, url string, html string")
    assert [r.href for r in pages.listing_links(df, *spec.LISTING_B).collect()] == ["http://h/5"]


def test_spec_from_json(spark):
    text = json.dumps({"instance": "i", "fields": spec.feed_a_spec()}, ensure_ascii=False)
    assert spec.read_spec(spark, text) == spec.feed_a_spec()
    for bad in ("not json", "{}", '{"fields": 3}'):
        with pytest.raises(spec.BadSpec):
            spec.read_spec(spark, bad)


# --- the whole way ---------------------------------------------------------------


@pytest.mark.parametrize("feed, fields", [("a", FEED_A_FIELDS), ("b", FEED_B_FIELDS)])
def test_file_to_mart(spark, tmp_path, monkeypatch, feed, fields):
    raw = D.raw(spark, "/root/testdata/sf0.001", feed)
    rows = raw.orderBy("id").select(*fields).collect()
    path = tmp_path / "feed.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
        writer.writerow(fields)
        writer.writerows([["\\N" if v is None else v for v in r] for r in rows])
    config = {"config_id": 2, "staging_fields": ", ".join(fields), "ignore_rows": 1}
    configs = spark.createDataFrame([(2, "two")], "config_id long, process_name string")
    logs = spark.createDataFrame([(7, 2, str(path), "C_SE")], "file_log_id long, config_id long, file_path string, status string")
    stamp = F.lit("2024-11-04 01:00:00").cast("timestamp_ntz")
    logs = logs.withColumns({"create_time": stamp, "update_at": stamp})
    logs = logs.select(*[(F.col(f.name) if f.name in logs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])
    paths = FeedPaths(**{n: str(tmp_path / n) for n in ("log", "staging", "dimension", "mart", "calendar", "runs")})
    calendar.date_dim(spark, *D.CALENDAR).write.parquet(paths.calendar)
    tables.reload(logs, paths.log)

    # the mart step fails after the dimension has been loaded
    sync = warehouse.Mart.sync
    monkeypatch.setattr(warehouse.Mart, "sync", lambda self: 1 / 0)
    with pytest.raises(LoadFailed) as failed:
        run_feed_files(spark, feed, config, configs, paths, D.AS_OF)
    assert failed.value.log.first().status == tables.read(spark, paths.log).first().status == "L_FE"
    monkeypatch.setattr(warehouse.Mart, "sync", sync)
    with pytest.raises(MissingInput):  # it is no longer ready
        run_feed_files(spark, feed, config, configs, paths, D.AS_OF)
    # the next run neither reads nor parses the file again
    for name in ("load_csv", "stage_feed"):
        monkeypatch.setattr(pipeline, name, lambda *a, **b: 1 / 0)
    done = run_feed_files(spark, feed, config, configs, paths, "2024-11-05 00:00:00", resume=7)
    assert done.first().status == "L_SE" and not os.listdir(paths.runs)
    with pytest.raises(MissingInput):
        run_feed_files(spark, feed, config, configs, paths, D.AS_OF, resume=7)

    staged = D.staged(spark, "/root/testdata/sf0.001", feed)
    loaded = warehouse.Dimension(spark, paths.dimension).read()
    synced = warehouse.Mart(spark, paths.mart, warehouse.Dimension(spark, paths.dimension)).read()
    assert loaded.count() == staged.count() == tables.read(spark, paths.staging).count() > 0
    assert synced.count() == loaded.count() and {str(r.created_at) for r in loaded.collect()} == {D.AS_OF}
    same = ["product_name", "price", "length", "width", "height", "weight", "manufacturer"]
    assert loaded.select(same).exceptAll(staged.select(same)).isEmpty()
    assert sorted(r.id for r in loaded.collect()) == list(range(1, loaded.count() + 1))


def test_a_ready_file_is_claimed_once(spark, tmp_path):
    logs = [(1, 2, "C_SE"), (2, 2, "C_SE"), (3, 2, "C_FE")]
    df = spark.createDataFrame(logs, "file_log_id long, config_id long, status string")
    stamp = F.lit("2024-11-04 01:00:00").cast("timestamp_ntz")
    df = df.withColumns({"create_time": stamp, "update_at": stamp, "file_path": F.lit("f")})
    df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])
    configs = spark.createDataFrame([(2, "two")], "config_id long, process_name string")
    one, two = (warehouse.Log(spark, str(tmp_path / "log")) for _ in range(2))
    one.table.replace(df)
    # the second run begins at the state the first one saw: its commit is refused
    base, _ = two.table.folder.head()
    seen = two.read()
    assert one.claim(configs, 2, D.AS_OF, "2024-11-04").file_log_id == 1
    with pytest.raises(Conflict):
        two.table.replace(control.transition(seen, 1, "L_P", D.AS_OF), base)
    assert two.claim(configs, 2, D.AS_OF, "2024-11-04").file_log_id == 2
    with pytest.raises(MissingInput):
        one.claim(configs, 2, D.AS_OF, "2024-11-04")
    assert {r.file_log_id: r.status for r in one.read().collect()} == {1: "L_P", 2: "L_P", 3: "C_FE"}


def test_two_feeds_into_one_dimension(spark):
    a = D.staged(spark, "/root/testdata/sf0.001", "a").orderBy("id").limit(60).cache()
    b = a.where("id <= 30").withColumn("price", F.col("price") + 1).cache()
    assert checks.duplicate_keys(a, KEYS).isEmpty()
    dim = spark.createDataFrame([], DIMENSION_SCHEMA)
    cal = calendar.date_dim(spark, *D.CALENDAR)
    loaded = load_feeds([a, b], dim, cal, D.AS_OF)
    current = loaded.where("NOT isDelete")
    assert checks.duplicate_keys(current, KEYS).isEmpty()
    assert current.count() == a.count() and loaded.count() == a.count() + b.count()
    assert loaded.select("id").distinct().count() == loaded.count()
    with pytest.raises(ValueError, match="one row per key"):
        history.scd2_load(dim, a.unionByName(a), cal, D.AS_OF)


def test_pages_to_csv(spark, tmp_path):
    df = spark.createDataFrame([(PAGE_A,), (PAGE_A,)], "html string")
    logs, path = warehouse.Log(spark, str(tmp_path / "log")), str(tmp_path / "out")
    row = pages_to_csv(df, spec.feed_a_spec(), path, logs, 2, D.AS_OF).first()
    assert (row.status, row["count"], row.file_path, row.file_log_id) == ("C_SE", 2, path, 1) and row.file_size >= 1
    rows = csv_feed.load_csv(spark, path, {"staging_fields": ", ".join(FEED_A_FIELDS)}).collect()
    assert [(r.name, r.images) for r in rows] == [("Chuột X1", "a.png, b.png")] * 2
    with pytest.raises(AlreadyRun):
        pages_to_csv(df, spec.feed_a_spec(), path, logs, 2, D.AS_OF)
    bad = [dict(spec.feed_a_spec()[0], type="css")]
    with pytest.raises(ExportFailed) as failed:
        pages_to_csv(df, bad, path, logs, 3, D.AS_OF)
    assert {r.config_id: r.status for r in failed.value.log.collect()} == {2: "C_SE", 3: "C_FE"}
    assert {r.config_id: r.status for r in logs.read().collect()} == {2: "C_SE", 3: "C_FE"}
