"""One query per operator, over the given tables or data derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import attributes as A
from shelfmark.functions import images as I
from shelfmark.operators import calendar as C
from shelfmark.operators import checks, control, history, mart, staging
from shelfmark.operators.lookup import all_present
from shelfmark.plans import derived as D
from shelfmark.plans import warehouse
from shelfmark.plans.pipeline import load_feeds, run_feed
from shelfmark.schemas import DIMENSION_SCHEMA, FEEDS, KEYS
from shelfmark.session import scratch_path, settle
from shelfmark.sources import csv_feed, pages, spec, tables
from shelfmark.sources.markup import attribute, inner, opening
from shelfmark.sources.versions import Conflict
from shelfmark.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
DAY = "1997-05-28"


def report(df: DataFrame) -> DataFrame:
    """Plain result types: long, double and text, so results compare across engines."""

    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return c

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


def _calendar(spark: SparkSession) -> DataFrame:
    return C.date_dim(spark, *D.CALENDAR)


def _loaded(spark: SparkSession, sf: str, feed: str = "a") -> tuple[DataFrame, DataFrame]:
    stg, dim = D.states(spark, sf, feed)
    return dim, history.scd2_load(dim, stg, _calendar(spark), D.AS_OF)


# --- attribute normalisers -----------------------------------------------------


def _parse(feed: str, column: str, parser) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        raw = D.raw(spark, sf, feed)
        return report(raw.select("id", parser(F.col(column)).alias(column)))

    return query


def _parse_size(feed: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        raw = D.raw(spark, sf, feed).select("id", "size")
        sized = A.with_size_a(raw) if feed == "a" else A.with_size_b(raw)
        return report(sized.select("id", "length", "width", "height"))

    return query


def image_list(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw(spark, sf, "a").select("id", I.image_list(F.col("images")).alias("image"))


def split_images(spark: SparkSession, sf: str) -> DataFrame:
    return report(I.split_images(D.raw(spark, sf, "a").select("id", "images")))


# --- staging -------------------------------------------------------------------


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return report(staging.dedup_keep_first(part, ["p_name", "p_brand"], "p_partkey"))


def drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return report(staging.drop_incomplete(D.typed(spark, sf, "a")).select("id", "product_name", "price"))


def dedup_collated(spark: SparkSession, sf: str) -> DataFrame:
    """Keys without regard to case, accents and trailing spaces."""
    varied = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.upper("p_name"), F.lit("  "))).otherwise(F.col("p_name"))
    part = D.table(spark, sf, "part").select("p_partkey", varied.alias("product_name"), F.col("p_brand").alias("manufacturer"))
    kept = staging.dedup_keep_first(history.with_key_collation(part), KEYS, "p_partkey")
    return report(kept.select("p_partkey"))


def parse_size_ignore_case(spark: SparkSession, sf: str) -> DataFrame:
    """The sizes of feed A, shouted."""
    raw = D.raw(spark, sf, "a").select("id", F.upper("size").alias("size"))
    return report(A.with_size_a(raw, ignore_case=True).select("id", "length", "width", "height"))


def _stored(load: Callable[[DataFrame, DataFrame, str], DataFrame]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "staging")
        stored = load(D.staged(spark, sf, "a"), D.staged(spark, sf, "b"), path)
        return report(stored.select("source", "id", *KEYS, "price", "length", "width", "height", "weight"))

    return query


def _reload(a: DataFrame, b: DataFrame, path: str) -> DataFrame:
    tables.reload(a, path)
    return tables.reload(b, path)


def _append(a: DataFrame, b: DataFrame, path: str) -> DataFrame:
    tables.reload(a, path)
    return tables.append(b, path)


def _stage_feed(feed: str) -> Query:
    return lambda spark, sf: report(staging.stage_feed(D.raw(spark, sf, feed), feed))


def union_feeds(spark: SparkSession, sf: str) -> DataFrame:
    both = staging.union_feeds(D.staged(spark, sf, "a"), D.staged(spark, sf, "b"))
    return report(both.select("source", "id", *KEYS, "price", "length", "width", "height", "weight"))


# --- history -------------------------------------------------------------------


def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    _, dim = D.states(spark, sf, "a")
    return report(history.current_rows(dim).select("id", *KEYS, "price", "expired_date"))


def new_products(spark: SparkSession, sf: str) -> DataFrame:
    return report(history.new_products(*D.states(spark, sf, "a")).select("id", *KEYS, "price"))


def changed_products(spark: SparkSession, sf: str) -> DataFrame:
    return report(history.changed_products(*D.states(spark, sf, "a")).select("id", *KEYS, "price", "sensor"))


def expire_ids(spark: SparkSession, sf: str) -> DataFrame:
    stg, dim = D.states(spark, sf, "a")
    return history.expire_ids(dim, history.changed_products(stg, dim))


def scd2_expire(spark: SparkSession, sf: str) -> DataFrame:
    stg, dim = D.states(spark, sf, "a")
    ids = history.expire_ids(dim, history.changed_products(stg, dim))
    expired = history.expire(dim, ids, D.AS_OF[:10])
    return report(expired.select("id", "isDelete", "date_delete", "expired_date"))


def scd2_load(spark: SparkSession, sf: str) -> DataFrame:
    return report(_loaded(spark, sf)[1])


def load_two_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Feed A loaded into an empty dimension, then feed B into the result."""
    empty = spark.createDataFrame([], DIMENSION_SCHEMA)
    feeds = [settle(D.staged(spark, sf, feed)) for feed in "ab"]
    loaded = load_feeds(feeds, empty, _calendar(spark), D.AS_OF)
    return report(loaded.select("id", "source", *KEYS, "price", "isDelete"))


def _stored_dimension(spark: SparkSession, sf: str) -> tuple[warehouse.Dimension, DataFrame]:
    stg, dim = D.states(spark, sf, "a")
    stored = warehouse.Dimension(spark, scratch_path(spark, "dimension"))
    stored.create(dim, _calendar(spark))
    return stored, stg


def scd2_increment(spark: SparkSession, sf: str) -> DataFrame:
    """The load by increments; a second load of the same name changes nothing."""
    stored, stg = _stored_dimension(spark, sf)
    for _ in range(2):
        stored.load(stg, _calendar(spark), D.AS_OF, "day")
    return report(stored.read())


def _varied(df: DataFrame) -> DataFrame:
    """Names in another case, with accents or trailing spaces."""
    name, of = F.col("product_name"), F.pmod(F.col("id"), F.lit(4))
    varied = F.when(of == 0, F.upper(name)).when(of == 1, F.translate(name, "eao", "éàô")).when(of == 2, F.concat(name, F.lit("  "))).otherwise(name)
    return df.withColumn("product_name", varied)


def _loaded_varied(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    stg, dim = D.states(spark, sf, "a")
    return dim, history.scd2_load(dim, _varied(stg), _calendar(spark), D.AS_OF, normal=True)


def scd2_load_collated(spark: SparkSession, sf: str) -> DataFrame:
    """The daily load where names compare without case, accents and trailing spaces."""
    return report(_loaded_varied(spark, sf)[1])


def mart_sync_collated(spark: SparkSession, sf: str) -> DataFrame:
    dim, loaded = _loaded_varied(spark, sf)
    return report(mart.mart_sync(D.mart(dim), settle(loaded), normal=True))


def _spread(rows: DataFrame, rows_per_file: int = 50_000) -> DataFrame:
    """Rows dealt out by their number, into one batch of files at most. A compressed table is
    read by a task or two, which would write all of the much longer texts of its rows."""
    return rows.repartition(min(rows.count() // rows_per_file + 1, arrivals.FILES_PER_BATCH))


def arrivals_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """Files of feed A arrive, the stream is cut off after the load and started again, then
    files of feed B arrive."""
    folder, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-checkpoint")
    stored = warehouse.Dimension(spark, scratch_path(spark, "dimension"))

    def cut(batch: int) -> None:
        raise RuntimeError("cut off")

    for feed, after in (("a", cut), ("a", None), ("b", None)):
        fields = ["id", *FEEDS[feed].fields]
        if after or feed == "b":
            csv_feed.export_csv(D.raw_feed(_spread(D.table(spark, sf, "part")), feed).select(*fields), f"{folder}/{feed}")
        config = {"staging_fields": ", ".join(fields)}
        options = {"loaded": after} if after else {}
        stream = arrivals.load_into_dimension(
            spark, f"{folder}/{feed}", config, f"{checkpoint}/{feed}", feed, stored, _calendar(spark), D.AS_OF, feed, **options
        )
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            if not after:
                raise
    return report(stored.read().select("id", "source", *KEYS, "price", "isDelete"))


# --- mart ----------------------------------------------------------------------


def mart_increment(spark: SparkSession, sf: str) -> DataFrame:
    """A mart that was synced whole, after the changes of one load."""
    stored, stg = _stored_dimension(spark, sf)
    shop = warehouse.Mart(spark, scratch_path(spark, "mart"), stored)
    shop.create(D.mart(stored.read()))
    stored.load(stg, _calendar(spark), D.AS_OF, "day")
    shop.sync()
    return report(shop.read())


def _mart_step(step: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        dim, loaded = _loaded(spark, sf)
        return report(step(D.mart(dim), settle(loaded)))

    return query


def _pipeline(feed: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        _, dim = D.states(spark, sf, feed)
        raw = D.raw(spark, sf, feed)
        return report(run_feed(raw, feed, dim, D.mart(dim), _calendar(spark), D.AS_OF)[2])

    return query


# --- calendar ------------------------------------------------------------------


def date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return report(C.date_dim_covering(D.table(spark, sf, "orders"), "o_orderdate"))


def date_fk(spark: SparkSession, sf: str) -> DataFrame:
    calendar = C.date_dim_covering(D.table(spark, sf, "lineitem"), "l_shipdate")
    known = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1))
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", known.cast("int").alias("date_fk"))
    return report(C.date_fk(orders, calendar, "o_orderdate", "date_fk"))


def date_dim_copy(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar written as CSV, loaded, stored, and copied to the warehouse."""
    source, staged, copied = (scratch_path(spark, name) for name in ("calendar-csv", "calendar", "calendar-copy"))
    C.date_dim_covering(D.table(spark, sf, "orders"), "o_orderdate").write.options(header="false", quoteAll="true").csv(source)
    tables.reload(csv_feed.load_date_dim(spark, source), staged)
    return report(tables.copy_table(spark, staged, copied))


# --- control -------------------------------------------------------------------


def ready_file(spark: SparkSession, sf: str) -> DataFrame:
    """The one ready file of a configuration on the last day it has one."""
    logs = D.logs(spark, sf)
    picked = _last_ready(logs)
    day = picked["create_time"].strftime("%Y-%m-%d")
    one = control.ready_file(logs, D.configs(spark, sf), picked["config_id"], day)
    return report(one.select("config_id", "process_name", "file_log_id", "file_path"))


def _last_ready(logs: DataFrame) -> Row:
    ready = logs.filter(F.col("status") == "C_SE")
    return ready.agg(F.max(F.struct("create_time", "config_id")).alias("last")).select("last.*").first()


def ready_file_today(spark: SparkSession, sf: str) -> DataFrame:
    """The same without a day, when that last day is today."""
    logs = D.logs(spark, sf)
    picked = _last_ready(logs)
    days = F.datediff(F.current_date(), F.lit(picked["create_time"].strftime("%Y-%m-%d")).cast("date"))
    moved = logs.withColumn("create_time", F.col("create_time") + F.make_dt_interval(days))
    one = control.ready_file(moved, D.configs(spark, sf), picked["config_id"])
    return report(one.select("config_id", "process_name", "file_log_id", "file_path"))


def log_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The stored log after runs have claimed the files of a configuration and day until
    none was ready; each claim began at the state that a run before had read."""
    log, configs = warehouse.Log(spark, scratch_path(spark, "log")), D.configs(spark, sf)
    log.table.replace(D.logs(spark, sf))
    picked = _last_ready(log.read())
    day = picked["create_time"].strftime("%Y-%m-%d")
    while True:
        base, _ = log.table.folder.head()
        late = log.read()
        try:
            claimed = log.claim(configs, picked["config_id"], D.AS_OF, day)
        except control.MissingInput:
            return report(log.read())
        try:
            log.table.replace(control.transition(late, claimed["file_log_id"], "L_P", D.AS_OF), base)
            raise AssertionError("two runs claimed one file")
        except Conflict:
            continue


def ready_files(spark: SparkSession, sf: str) -> DataFrame:
    ready = control.ready_files(D.logs(spark, sf), D.configs(spark, sf))
    return report(ready.select("config_id", "process_name", "day", "file_log_id", "file_path"))


def logs_on_day(spark: SparkSession, sf: str) -> DataFrame:
    return report(control.on_day(D.logs(spark, sf), "create_time", DAY).select("file_log_id", "config_id", "status"))


def log_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return report(control.by_id(D.logs(spark, sf), "file_log_id", 1))


def run_guard(spark: SparkSession, sf: str) -> DataFrame:
    return control.run_guard(D.logs(spark, sf), D.configs(spark, sf), DAY)


def log_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = control.file_paths(
        D.configs(spark, sf), "/data", F.col("file_name"), F.lit(D.AS_OF).cast("timestamp_ntz")
    ).select("config_id", "file_path", F.lit(0).alias("count"), F.lit("C_E").alias("status"))
    return report(control.log_insert(D.logs(spark, sf), rows, D.AS_OF))


def log_update(spark: SparkSession, sf: str) -> DataFrame:
    logs = D.logs(spark, sf)
    lines = D.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("file_log_id")).agg(
        F.count("*").alias("count"), F.ceil(F.sum("l_quantity")).cast("decimal(10,2)").alias("file_size")
    )
    crawling = logs.filter(F.col("status") == "C_E").select("file_log_id", F.lit("C_SE").alias("status"))
    return report(control.log_update(logs, crawling.join(lines, "file_log_id"), D.AS_OF, check=True))


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    return control.run_report(D.logs(spark, sf), D.configs(spark, sf))


def file_paths(spark: SparkSession, sf: str) -> DataFrame:
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    paths = control.file_paths(orders, "/data", F.col("o_orderpriority"), F.col("o_orderdate"))
    return paths.select("o_orderkey", "file_path")


# --- files ---------------------------------------------------------------------

CUSTOMER_FIELDS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    customer = D.table(spark, sf, "customer").select(*csv_feed.map_columns(CUSTOMER_FIELDS))
    written = csv_feed.export_csv(customer, path)
    loaded = csv_feed.load_csv(spark, path, {"staging_fields": CUSTOMER_FIELDS, "ignore_rows": 1})
    ids = loaded.agg(F.count_distinct("id"), F.sum("id")).first()
    return loaded.select(
        F.col("c_custkey").cast("long"),
        "c_name",
        F.col("c_nationkey").cast("long"),
        F.col("c_acctbal").cast("double"),
        "c_mktsegment",
        F.lit(written).cast("long").alias("written"),
        F.lit(ids[0]).cast("long").alias("ids"),
        F.lit(ids[1]).cast("long").alias("id_sum"),
    )


TEXT_FIELDS = "doc_id, source, text"


def _loaded_texts(spark: SparkSession, path: str, **dialect: str) -> DataFrame:
    loaded = csv_feed.load_csv(spark, path, {"staging_fields": TEXT_FIELDS, **dialect})
    ids = loaded.agg(F.count_distinct("id"), F.sum("id")).first()
    return loaded.select(
        F.col("doc_id").cast("long"),
        "source",
        F.char_length("text").cast("long").alias("chars"),
        F.md5("text").alias("text_md5"),
        F.lit(ids[0]).cast("long").alias("ids"),
        F.lit(ids[1]).cast("long").alias("id_sum"),
    )


def csv_escapes(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes, line breaks, backslashes and NULL, out with escapes and back."""
    path = scratch_path(spark, "csv")
    text = F.when(F.col("doc_id") % 10 != 0, F.concat("text", F.lit('\\N "x\\"\r\n\t')))
    csv_feed.export_csv(D.table(spark, sf, "documents").select("doc_id", "source", text.alias("text")), path)
    return _loaded_texts(spark, path)


def csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """The same kind of texts from files that have their line breaks as they are, in quotes."""
    path = scratch_path(spark, "csv")
    text = F.concat("text", F.lit('\\N "x\\"\n\n\t,\n'))
    texts = D.table(spark, sf, "documents").select("doc_id", "source", text.alias("text"))
    texts.write.options(header="true", quoteAll="true", quote='"', escape='"', emptyValue="").options(
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return _loaded_texts(spark, path, escaped_by="")


def file_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and bytes of a written folder of texts."""
    path = scratch_path(spark, "texts")
    D.table(spark, sf, "customer").select(F.concat_ws(", ", "c_name", "c_mktsegment").alias("value")).write.text(path)
    return csv_feed.file_stats(spark.read.text(path), path).select("rows", "bytes", "size_kb")


# --- pages ---------------------------------------------------------------------


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NAV, _LINK = opening("nav"), opening("a") + inner("a")
PAGE_SPEC = [
    spec.rule("title", opening("title") + inner("title")),
    spec.rule("heading", opening("h1") + inner("h1"), within=opening("article")),
    spec.rule("lang", attribute("html", "lang"), "lang"),
    spec.rule("nav_texts", _LINK, within=_NAV),
    spec.rule("nav_links", attribute("a", "href"), "href", _NAV),
    spec.rule("first_nav", _LINK, within=_NAV, number="first"),
    spec.rule("ad", opening("div", "class", "ad") + inner("div")),
    spec.rule("ad_by_sibling", r"</nav\s*>\s*" + opening("div") + inner("div")),
    spec.rule("nav_with_e", f"{opening('a')}(?={inner('a')}){inner('a')}", within=_NAV, label="(?i)e"),
    spec.rule("price", opening("span", "class", "product-price") + inner("span")),
    spec.rule("ends", opening("title") + inner("title")),
    spec.rule("ends", opening("footer") + inner("footer")),
]


def html_extract_fields(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract_fields(D.table(spark, sf, "pages"), PAGE_SPEC)


NESTED_SPEC = [f for f in PAGE_SPEC if f["field_name"] in ("title", "ad", "ad_by_sibling")]


def html_nested_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Values that hold elements of their own kind, also one of the same pattern."""
    ad = '<div class="ad">'
    nested = F.replace("html", F.lit(ad), F.lit(f'{ad}<div>in</div><div class="b"><div>deep</div>er</div>'))
    twice = F.replace(nested, F.lit("<div>deep</div>"), F.when(F.col("page_id") % 2 == 0, f"<div>{ad}deep</div></div>").otherwise("<div>deep</div>"))
    return pages.extract_fields(D.table(spark, sf, "pages").select("page_id", "url", twice.alias("html")), NESTED_SPEC)


def html_extract_links(spark: SparkSession, sf: str) -> DataFrame:
    return report(pages.extract_links(D.table(spark, sf, "pages"), "<li>.*?</li>"))


def html_listing_links(spark: SparkSession, sf: str) -> DataFrame:
    return report(pages.listing_links(D.table(spark, sf, "pages"), opening("li"), _NAV))


def html_compose(spark: SparkSession, sf: str) -> DataFrame:
    blocks = [
        ("<nav>.*?</nav>", None),
        ("<h1>.*?</h1>", None),
        ("<footer>.*?</footer>", "table-1"),
        ("<table>.*?</table>", "table-2"),
    ]
    return pages.compose_fragments(D.table(spark, sf, "pages"), "product", blocks)


def absolutize_urls(spark: SparkSession, sf: str) -> DataFrame:
    relative = F.replace(F.col("html"), F.lit('<a href="/'), F.lit('<img src="//cdn.example/'))
    relative = F.replace(relative, F.lit('<div class="'), F.lit('<div data-image="//img.example/'))
    html = pages.absolutize_urls(relative, F.col("url"))
    rows = D.table(spark, sf, "pages").select("page_id", html.alias("html"))
    return rows.select("page_id", F.char_length("html").cast("long").alias("chars"), F.md5("html").alias("html_md5"))


def spec_from_json(spark: SparkSession, sf: str) -> DataFrame:
    parsed = spec.spec_from_json(F.col("props"), "k bigint")
    return D.table(spark, sf, "events").select("event_id", parsed.getField("k").alias("k"))


# --- checks --------------------------------------------------------------------


def spec_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Specifications in their full shape, one per customer, read back."""
    rule = F.struct(F.col("c_name").alias("field_name"), F.lit("single").alias("number"), F.lit("text").alias("attr"),
                    F.lit("value").alias("type"), F.col("c_mktsegment").alias("selector"))
    text = F.to_json(F.struct(F.lit("i").alias("instance"), F.array(rule, rule).alias("fields")))
    parsed = spec.spec_from_json(F.when(F.col("c_custkey") % 10 == 0, F.lit("not json")).otherwise(text))
    rows = D.table(spark, sf, "customer").select("c_custkey", parsed.alias("s"))
    return report(rows.select(
        "c_custkey", F.col("s.instance").alias("instance"), F.size("s.fields").alias("n_fields"),
        F.col("s.fields")[1]["field_name"].alias("field_name"), F.col("s.fields")[1]["selector"].alias("selector"),
    ))


def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    events, supplier = D.table(spark, sf, "events"), D.table(spark, sf, "supplier")
    lost = checks.orphans(events.select("event_id", "user_id", "event_type"), supplier, "user_id", "s_suppkey", "event_id")
    return lost


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(D.table(spark, sf, "part"), ["p_name", "p_brand"])


def check_dimension_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Per number of current versions, the number of complete keys after both feeds."""
    current = load_two_feeds(spark, sf).where(~F.col("isDelete") & all_present(KEYS))
    versions = current.groupBy(*KEYS).agg(F.count("*").alias("versions"))
    return versions.groupBy("versions").agg(F.count("*").alias("keys"))


def check_domain(spark: SparkSession, sf: str) -> DataFrame:
    return checks.violations(
        D.table(spark, sf, "orders"),
        "o_orderkey",
        domains={"o_orderstatus": ("O", "F")},
        required=("o_orderdate", "o_custkey"),
        lengths={"o_orderpriority": 8},
    )


QUERIES: dict[str, Query] = {
    "parse_price_a": _parse("a", "price", A.parse_price_a),
    "parse_price_b": _parse("b", "price", A.parse_price_b),
    "parse_weight_a": _parse("a", "weight", A.parse_weight_a),
    "parse_weight_b": _parse("b", "weight", A.parse_weight_b),
    "parse_size_a": _parse_size("a"),
    "parse_size_ignore_case": parse_size_ignore_case,
    "parse_size_b": _parse_size("b"),
    "image_list": image_list,
    "split_images": split_images,
    "dedup_keep_first": dedup_keep_first,
    "dedup_collated": dedup_collated,
    "drop_incomplete": drop_incomplete,
    "staging_reload": _stored(_reload),
    "staging_append": _stored(_append),
    "stage_feed_a": _stage_feed("a"),
    "stage_feed_b": _stage_feed("b"),
    "union_feeds": union_feeds,
    "scd2_current": scd2_current,
    "new_products": new_products,
    "changed_products": changed_products,
    "expire_ids": expire_ids,
    "scd2_expire": scd2_expire,
    "scd2_load": scd2_load,
    "load_two_feeds": load_two_feeds,
    "scd2_increment": scd2_increment,
    "scd2_load_collated": scd2_load_collated,
    "mart_sync_collated": mart_sync_collated,
    "arrivals_exactly_once": arrivals_exactly_once,
    "mart_increment": mart_increment,
    "mart_update": _mart_step(mart.mart_update),
    "mart_insert": _mart_step(mart.mart_insert),
    "mart_delete": _mart_step(mart.mart_delete),
    "mart_sync": _mart_step(mart.mart_sync),
    "pipeline_feed_a": _pipeline("a"),
    "pipeline_feed_b": _pipeline("b"),
    "date_dim": date_dim,
    "date_dim_copy": date_dim_copy,
    "date_fk": date_fk,
    "ready_file": ready_file,
    "ready_file_today": ready_file_today,
    "log_claims": log_claims,
    "ready_files": ready_files,
    "logs_on_day": logs_on_day,
    "log_by_id": log_by_id,
    "run_guard": run_guard,
    "log_insert": log_insert,
    "log_update": log_update,
    "run_report": run_report,
    "file_paths": file_paths,
    "csv_roundtrip": csv_roundtrip,
    "csv_escapes": csv_escapes,
    "csv_line_breaks": csv_line_breaks,
    "file_stats": file_stats,
    "html_extract_fields": html_extract_fields,
    "html_nested_fields": html_nested_fields,
    "html_extract_links": html_extract_links,
    "html_listing_links": html_listing_links,
    "html_compose": html_compose,
    "absolutize_urls": absolutize_urls,
    "spec_from_json": spec_from_json,
    "check_fk": check_fk,
    "spec_shape": spec_shape,
    "check_dimension_keys": check_dimension_keys,
    "check_unique": check_unique,
    "check_domain": check_domain,
}
