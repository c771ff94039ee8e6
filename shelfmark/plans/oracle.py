"""Expected results as plain SQL over the same tables.

The attribute values are computed from the part key, not parsed from text, so the
SQL does not share the normalisers' logic; the merge steps are written as the
EXISTS / NOT EXISTS / IN statements they stand for.
"""

from __future__ import annotations

from shelfmark.plans import derived as D
from shelfmark.plans.queries import DAY, LOWER, UPPER
from shelfmark.schemas import COMPARED, KEYS, MART, PRODUCT

_DAY_OF_LOAD = D.AS_OF[:10]


def _dim_value(code: str | None) -> str:
    """SQL for one expected dimension: see the template tables."""
    if code is None:
        return "NULL"
    n = code[0]
    unit = code[1:]
    return {
        "": f"CAST({n} AS DOUBLE) / 10",
        "|": f"CAST({n} // 10 AS DOUBLE)",
        "c": f"CAST({n} AS DOUBLE) / 100",
        "c|": f"CAST({n} // 100 * 10 AS DOUBLE)",
    }[unit]


def _sizes(templates, i: int) -> str:
    whens = " ".join(f"WHEN {n} THEN {_dim_value(dims[i])}" for n, (_, dims) in enumerate(templates))
    return f"CASE k % {len(templates)} {whens} END"


def _weights(templates) -> str:
    whens = " ".join(
        f"WHEN {n} THEN " + ("NULL" if v is None else f"CAST({v[0]} * g + {v[1]} AS DOUBLE) / 10")
        for n, (_, v) in enumerate(templates)
    )
    return f"CASE k % {len(templates)} {whens} END"


def _images(prefix: str) -> str:
    return (
        f"list_aggregate(['{prefix}https://shop/p' || k || '_' || i || '.png' for i in range(1, 2 + k % 14)],"
        " 'string_agg', ', ')"
    )


_PREFIX = "https://cdn/insecure/q:90/plain/"


def _typed(feed: str) -> str:
    sizes = D.SIZE_TEXTS_A if feed == "a" else D.SIZE_TEXTS_B
    weights = D.WEIGHT_TEXTS_A if feed == "a" else D.WEIGHT_TEXTS_B
    million = "" if feed == "a" else " + CASE WHEN k % 5 = 0 THEN 1000 ELSE 0 END"
    return f"""
SELECT k + 1 AS id, p_name AS product_name,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST((100 + k % 900{million}) * 1000 AS DOUBLE) END AS price,
  {_images("" if feed == "a" else _PREFIX)} AS image,
  {_sizes(sizes, 0)} AS length, {_sizes(sizes, 1)} AS width, {_sizes(sizes, 2)} AS height,
  {_weights(weights)} AS weight,
  100 * (k % 9 + 1) || ' dpi' AS resolution, 'S' || k % 7 AS sensor, 'C' || k % 3 AS connectivity,
  'B' || k % 4 AS battery, 'O' || k % 5 AS compatibility,
  CASE WHEN k % 37 = 0 THEN NULL ELSE p_brand END AS manufacturer,
  '{D.CREATED}' AS created_at, 'feed_{feed}' AS source
FROM (SELECT p_partkey AS k, p_name, p_brand, 50 + p_partkey % 70 AS g, 1000 + p_partkey % 300 AS l,
  550 + p_partkey % 150 AS w, 300 + p_partkey % 130 AS h FROM part)"""


_STAGED = """
SELECT * FROM typed s1 WHERE product_name IS NOT NULL AND price IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM typed s2 WHERE s2.product_name = s1.product_name AND s2.manufacturer = s1.manufacturer
    AND s2.id < s1.id)"""

_DIM = f"""
SELECT id, product_name,
  CASE WHEN live AND battery = 'B1' THEN price - 1000 ELSE price END AS price,
  image, length, width, height, weight, resolution,
  CASE WHEN live AND connectivity = 'C2' THEN NULL ELSE sensor END AS sensor,
  connectivity, battery, compatibility, manufacturer, created_at, source,
  NOT live OR compatibility = 'O4' AS isDelete,
  CASE WHEN NOT live THEN '2024-06-30' WHEN compatibility = 'O4' THEN '2024-10-01' END AS date_delete,
  created_at AS date_insert,
  CASE WHEN NOT live THEN '2024-06-30' WHEN compatibility = 'O4' THEN '2024-10-01' ELSE '9999-12-31' END AS expired_date,
  CASE WHEN battery <> 'B3' THEN CAST(7247 AS BIGINT) END AS date_insert_fk
FROM (SELECT t.*, t.id IN (SELECT id FROM stg) AS live FROM typed t)
WHERE manufacturer IS NULL OR manufacturer <> 'Brand#7'"""

_SAME_KEY = "d.product_name = s.product_name AND d.manufacturer = s.manufacturer"
_CURRENT = "NOT d.isDelete AND d.expired_date = '9999-12-31'"
_DIFFERS = " OR ".join(f"d.{c} <> s.{c}" for c in COMPARED)

_FRESH = f"SELECT s.* FROM stg s WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE {_SAME_KEY})"
_CHANGED = f"SELECT s.* FROM stg s WHERE EXISTS (SELECT 1 FROM dim d WHERE {_SAME_KEY} AND {_CURRENT} AND ({_DIFFERS}))"
_IDS = f"SELECT DISTINCT d.id FROM dim d JOIN changed s ON {_SAME_KEY} WHERE {_CURRENT}"
_PRODUCT = ", ".join(PRODUCT)
_LOADED = f"""
SELECT id, {_PRODUCT}, created_at, source,
  isDelete OR id IN (SELECT id FROM ids) AS isDelete,
  CASE WHEN id IN (SELECT id FROM ids) THEN '{_DAY_OF_LOAD}' ELSE date_delete END AS date_delete,
  date_insert,
  CASE WHEN id IN (SELECT id FROM ids) THEN '{_DAY_OF_LOAD}' ELSE expired_date END AS expired_date,
  COALESCE(date_insert_fk, 7247) AS date_insert_fk
FROM dim
UNION ALL
SELECT (SELECT MAX(id) FROM dim) + ROW_NUMBER() OVER (ORDER BY kind, id) AS id, {_PRODUCT},
  '{D.AS_OF}', source, FALSE, NULL, '{D.AS_OF}', '9999-12-31', 7248
FROM (SELECT 0 AS kind, * FROM fresh UNION ALL SELECT 1 AS kind, * FROM changed)"""

_MART = f"""SELECT {", ".join(MART)} FROM dim
WHERE expired_date > '2024-06-30' AND manufacturer IS NOT NULL AND product_name NOT LIKE 'small %'"""
_DW = "SELECT d.* FROM loaded d WHERE NOT d.isDelete"
_UPDATED = "SELECT " + ", ".join(
    f"m.{c}" if c in KEYS else f"CASE WHEN s.id IS NOT NULL THEN s.{c} ELSE m.{c} END AS {c}" for c in MART
) + """
FROM mart m LEFT JOIN dw s ON m.product_name = s.product_name AND m.manufacturer = s.manufacturer AND (""" + " OR ".join(
    f"m.{c} <> s.{c}" for c in COMPARED
) + ")"
_MART_COLUMNS = ", ".join(MART)


def _not_in(mart: str) -> str:
    return f"SELECT {_MART_COLUMNS} FROM dw WHERE product_name NOT IN (SELECT product_name FROM {mart})"


def _without_deleted(mart: str) -> str:
    return f"SELECT {_MART_COLUMNS} FROM {mart} WHERE id NOT IN (SELECT id FROM loaded WHERE isDelete)"


_STEPS = {
    "stg": _STAGED,
    "dim": _DIM,
    "fresh": _FRESH,
    "changed": _CHANGED,
    "ids": _IDS,
    "loaded": _LOADED,
    "mart": _MART,
    "dw": _DW,
    "updated": _UPDATED,
    "synced": f"SELECT {_MART_COLUMNS} FROM updated UNION ALL {_not_in('updated')}",
}


def _with(last: str | None, select: str, feed: str = "a") -> str:
    """``select`` after all steps up to ``last``."""
    names = list(_STEPS)
    used = names[: names.index(last) + 1] if last else []
    ctes = [f"typed AS ({_typed(feed)})"] + [f"{n} AS ({_STEPS[n]})" for n in used]
    return f"WITH {', '.join(ctes)} {select}"


def _parsed(feed: str, columns: str) -> str:
    return _with(None, f"SELECT id, {columns} FROM typed", feed)


_LOGS = """logs AS (SELECT o_orderkey AS file_log_id, o_custkey AS config_id, o_orderdate AS create_time,
  '/data/feed_' || o_custkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS file_path,
  CAST(floor(o_totalprice) AS BIGINT) AS count, CAST(ceil(o_totalprice / 1024) AS DOUBLE) AS file_size,
  o_orderdate + INTERVAL 30 MINUTE AS update_at,
  CASE o_orderstatus WHEN 'F' THEN 'C_SE' WHEN 'O' THEN 'C_E' ELSE 'C_FE' END AS status FROM orders)"""
_STAMP = "'%Y-%m-%d %H:%M:%S'"
_LOG_TEXT = (
    f"file_log_id, config_id, strftime(create_time, {_STAMP}) AS create_time, file_path, count, file_size,"
    f" strftime(update_at, {_STAMP}) AS update_at, status"
)

_DATE_DIM = """
SELECT CAST(date_diff('day', DATE '2005-01-01', d) + 1 AS BIGINT) AS date_sk, strftime(d, '%Y-%m-%d') AS full_date,
  CAST(date_diff('day', DATE '2005-01-01', d) + 1 AS BIGINT) AS day_since_2005,
  CAST((year(d) - 2005) * 12 + month(d) AS BIGINT) AS month_since_2005, strftime(d, '%A') AS day_of_week,
  strftime(d, '%B') AS calendar_month, CAST(year(d) AS BIGINT) AS calendar_year,
  strftime(d, '%Y-%b') AS calendar_year_month, CAST(day(d) AS BIGINT) AS day_of_month,
  CAST(dayofyear(d) AS BIGINT) AS day_of_year, CAST(strftime(d, '%U') AS BIGINT) AS week_of_year_sunday,
  strftime(d, '%Y-W%U') AS year_week_sunday,
  strftime(d - CAST(dayofweek(d) AS INTEGER), '%Y-%m-%d') AS week_sunday_start,
  CAST(strftime(d, '%W') AS BIGINT) AS week_of_year_monday, strftime(d, '%Y-W%W') AS year_week_monday,
  strftime(d - CAST(isodow(d) - 1 AS INTEGER), '%Y-%m-%d') AS week_monday_start, 'Non-Holiday' AS holiday,
  CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders))"""

_DATE_FK = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1
    WHEN CAST(o_orderdate AS DATE) BETWEEN lo AND hi
    THEN CAST(date_diff('day', DATE '2005-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) END AS date_fk
FROM orders, (SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)"""


def _unescape(sql: str) -> str:
    # in HTML text these references count with and without the semicolon
    for entity, char in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
        sql = f"regexp_replace({sql}, '{entity}', '{char}', 'g')"
    return f"trim(regexp_replace({sql}, '[ \\t\\n\\f\\r]+', ' ', 'g'))"


def _between(left: str, right: str) -> str:
    return _unescape(f"regexp_extract(html, '{left}(.*?){right}', 1, 's')")


_NAV = "regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>', 0, 's'), '{0}', {1})"
_NAV_TEXTS = _NAV.format(">([^<>]*)</a>", 1)
_HTML_FIELDS = f"""
SELECT page_id, url, {_between("<title>", "</title>")} AS title, {_between("<h1>", "</h1>")} AS heading,
  regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  coalesce(list_aggregate([{_unescape("t")} for t in {_NAV_TEXTS}], 'string_agg', ', '), '') AS nav_texts,
  coalesce(list_aggregate({_NAV.format('<a href="([^"]*)"', 1)}, 'string_agg', ', '), '') AS nav_links,
  {_unescape(f"coalesce({_NAV_TEXTS}[1], '')")} AS first_nav,
  {_between('<div class="ad">', "</div>")} AS ad, {_between('<div class="ad">', "</div>")} AS ad_by_sibling,
  coalesce(list_aggregate([{_unescape("t")} for t in {_NAV_TEXTS}
    if contains(translate(t, '{UPPER}', '{LOWER}'), 'e')], 'string_agg', ', '), '') AS nav_with_e,
  '' AS price, {_between("<title>", "</title>")} || ', ' || {_between("<footer>", "</footer>")} AS ends
FROM pages"""

_ENTITIES = "replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"

_LINKS = f"""
SELECT page_id, CAST(generate_subscripts(hrefs, 1) AS BIGINT) AS n,
  regexp_extract(url, '^https?://[^/]+') || {_ENTITIES.format("unnest(hrefs)")} AS href FROM (
  SELECT page_id, url, [regexp_extract(b, '<a\\b[^>]*?\\bhref="([^"]*)"', 1, 's')
    for b in regexp_extract_all(html, '<li>.*?</li>', 0, 's')] AS hrefs FROM pages)"""

_LISTING = f"""
SELECT page_id, CAST(generate_subscripts(hrefs, 1) AS BIGINT) AS n,
  regexp_extract(url, '^https?://[^/]+') || {_ENTITIES.format("unnest(hrefs)")} AS href
FROM (SELECT page_id, url, {_NAV.format('<li><a href="([^"]*)"', 1)} AS hrefs FROM pages)"""

_COMPOSE = """
SELECT page_id, url, '<section id="product">' || chr(10) || regexp_extract(html, '<nav>.*?</nav>', 0, 's') || chr(10)
  || regexp_extract(html, '<h1>.*?</h1>', 0, 's') || chr(10)
  || '<section id="table-1">' || regexp_extract(html, '<footer>.*?</footer>', 0, 's') || '</section>' || chr(10)
  || '<section id="table-2">' || regexp_extract(html, '<table>.*?</table>', 0, 's') || '</section>' || chr(10)
  || '</section>' AS fragment FROM pages"""

_ABSOLUTE = """
SELECT page_id, CAST(length(h) AS BIGINT) AS chars, md5(h) AS html_md5 FROM (
  SELECT page_id, replace(replace(html, '<a href="/', '<img src="' || p || '//cdn.example/'),
    '<div class="', '<div data-image="' || p || '//img.example/') AS h
  FROM (SELECT page_id, html, CASE WHEN url LIKE 'https%' THEN 'https:' ELSE 'http:' END AS p FROM pages))"""

_DEDUP = """SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part s1
  WHERE NOT EXISTS (SELECT 1 FROM part s2 WHERE s2.p_name = s1.p_name AND s2.p_brand = s1.p_brand
    AND s2.p_partkey < s1.p_partkey)"""

_REPORT = f"""WITH {_LOGS} SELECT file_log_id, c_name AS process_name,
  CASE status WHEN 'C_SE' THEN 'Crawl Success' WHEN 'C_E' THEN 'Crawling' ELSE 'Crawl Failure' END AS status,
  strftime(create_time, '%d/%m/%Y - %I:%M:%S %p') AS start_time,
  strftime(update_at, '%d/%m/%Y - %I:%M:%S %p') AS end_time,
  CASE WHEN status = 'C_FE' THEN 'None'
    ELSE 'count: ' || count || ', file size: ' || CAST(file_size AS BIGINT) || ' kb' END AS note,
  CASE WHEN status = 'C_FE' THEN 'Crawl Failure' ELSE 'None' END AS reason
FROM logs JOIN customer ON config_id = c_custkey"""

_UPDATE = f"""WITH {_LOGS}, lines AS (
  SELECT l_orderkey, COUNT(*) AS n, ceil(SUM(l_quantity)) AS q FROM lineitem GROUP BY l_orderkey),
upd AS (SELECT file_log_id, n, q FROM logs JOIN lines ON file_log_id = l_orderkey WHERE status = 'C_E')
SELECT l.file_log_id, config_id, strftime(create_time, {_STAMP}) AS create_time, file_path,
  CAST(COALESCE(n, count) AS BIGINT) AS count, CAST(COALESCE(q, file_size) AS DOUBLE) AS file_size,
  CASE WHEN u.file_log_id IS NULL THEN strftime(update_at, {_STAMP}) ELSE '{D.AS_OF}' END AS update_at,
  CASE WHEN u.file_log_id IS NULL THEN status ELSE 'C_SE' END AS status
FROM logs l LEFT JOIN upd u ON l.file_log_id = u.file_log_id"""

_INSERT = f"""WITH {_LOGS} SELECT {_LOG_TEXT} FROM logs UNION ALL
SELECT (SELECT MAX(file_log_id) FROM logs) + ROW_NUMBER() OVER (ORDER BY c_custkey), c_custkey, '{D.AS_OF}',
  '/data/' || lower(c_mktsegment) || '_{_DAY_OF_LOAD}.csv', 0, NULL, '{D.AS_OF}', 'C_E' FROM customer"""

_READY = f"""WITH {_LOGS}, ready AS (SELECT *, strftime(create_time, '%Y-%m-%d') AS day,
  ROW_NUMBER() OVER (PARTITION BY config_id, CAST(create_time AS DATE) ORDER BY file_log_id) AS rn
  FROM logs WHERE status = 'C_SE')
SELECT config_id, c_name AS process_name, day, file_log_id, file_path
FROM ready JOIN customer ON config_id = c_custkey WHERE rn = 1"""

_STG_COLUMNS = "id, " + _PRODUCT + ", created_at, source"
_UNION = "SELECT source, id, product_name, manufacturer, price, length, width, height, weight FROM"


def _feed_steps(feed: str) -> str:
    staged = _STAGED.replace("typed", f"typed_{feed}")
    return f"typed_{feed} AS ({_typed(feed)}), stg_{feed} AS ({staged})"


def _union_feeds() -> str:
    return f"WITH {_feed_steps('a')}, {_feed_steps('b')} {_UNION} stg_a UNION ALL {_UNION} stg_b"


_FEED_ROWS = {f: f"WITH {_feed_steps(f)} {_UNION} stg_{f}" for f in "ab"}

_TWO_FEEDS = f"""WITH {_feed_steps("a")}, {_feed_steps("b")},
one AS (SELECT ROW_NUMBER() OVER (ORDER BY id) AS id, * EXCLUDE (id) FROM stg_a),
pairs AS (SELECT s.id AS stg_id, d.id AS dim_id, ({_DIFFERS}) AS differs FROM stg_b s LEFT JOIN one d ON {_SAME_KEY}),
act AS (SELECT stg_id, CASE WHEN MAX(dim_id) IS NULL THEN 0 WHEN BOOL_OR(COALESCE(differs, FALSE)) THEN 1 END AS a
  FROM pairs GROUP BY stg_id),
added AS (SELECT (SELECT MAX(id) FROM one) + ROW_NUMBER() OVER (ORDER BY a, id) AS new_id, s.*
  FROM stg_b s JOIN act ON stg_id = id WHERE a IS NOT NULL),
both_feeds AS (SELECT id, source, product_name, manufacturer, price, EXISTS (
    SELECT 1 FROM pairs JOIN act USING (stg_id) WHERE dim_id = one.id AND a = 1) AS isDelete FROM one
  UNION ALL SELECT new_id, source, product_name, manufacturer, price, FALSE FROM added)"""



def _again(sql: str, mart: str, dw: str) -> str:
    """A mart step over another mart and warehouse."""
    return sql.replace("FROM mart m", f"FROM {mart} m").replace("JOIN dw s", f"JOIN {dw} s").replace("FROM dw ", f"FROM {dw} ")


_TWICE = ", ".join(
    (
        "before AS (SELECT * FROM dim d WHERE NOT d.isDelete)",
        f"updated0 AS ({_again(_UPDATED, 'mart', 'before')})",
        f"synced0 AS (SELECT {_MART_COLUMNS} FROM updated0 UNION ALL {_again(_not_in('updated0'), 'mart', 'before')})",
        f"mart1 AS (SELECT {_MART_COLUMNS} FROM synced0 WHERE id NOT IN (SELECT id FROM dim WHERE isDelete))",
        f"updated1 AS ({_again(_UPDATED, 'mart1', 'dw')})",
        f"synced1 AS (SELECT {_MART_COLUMNS} FROM updated1 UNION ALL {_not_in('updated1')})",
    )
)
_TWICE_SYNCED = f"{_with('dw', '').rstrip()}, {_TWICE} {_without_deleted('synced1')}"

def _collated(sql: str) -> str:
    """The same statement with names and manufacturers compared by their plain form."""
    for one, other in (("d", "s"), ("m", "s")):
        for key in KEYS:
            equal = " = ".join(f"lower(strip_accents(rtrim({t}.{key})))" for t in (one, other))
            sql = sql.replace(f"{one}.{key} = {other}.{key}", equal)
    plain = "lower(strip_accents(rtrim(product_name)))"
    return sql.replace("product_name NOT IN (SELECT product_name FROM", f"{plain} NOT IN (SELECT {plain} FROM")


_VARIED = """varied AS (SELECT * REPLACE (CASE id % 4 WHEN 0 THEN upper(product_name)
  WHEN 1 THEN translate(product_name, 'eao', 'éàô') WHEN 2 THEN product_name || '  ' ELSE product_name END AS product_name)
  FROM stg)"""


def _with_varied(last: str, select: str) -> str:
    # the warehouse was loaded with the names as they were
    before, load = _with(last, select).split(", fresh AS (", 1)
    return f"{before}, {_VARIED}, " + _collated(f"fresh AS ({load}".replace("FROM stg s", "FROM varied s"))


_LAST_READY = """last AS (SELECT create_time AS t, config_id AS c FROM logs WHERE status = 'C_SE'
      ORDER BY create_time DESC, config_id DESC LIMIT 1)"""
_CLAIMED = "status = 'C_SE' AND config_id = c AND CAST(create_time AS DATE) = CAST(t AS DATE)"


def _texts(text: str) -> str:
    return (
        "SELECT doc_id, source, CAST(length(t) AS BIGINT) AS chars, md5(t) AS text_md5,"
        " (SELECT COUNT(*) FROM documents) AS ids, (SELECT CAST(COUNT(*) * (COUNT(*) + 1) // 2 AS BIGINT) FROM documents) AS id_sum"
        f" FROM (SELECT *, {text} AS t FROM documents)"
    )


ORACLE: dict[str, str] = {
    "scd2_increment": _with("loaded", "SELECT * FROM loaded"),
    "scd2_load_collated": _with_varied("loaded", "SELECT * FROM loaded"),
    "mart_sync_collated": _with_varied("synced", _without_deleted("synced")),
    "arrivals_exactly_once": f"{_TWO_FEEDS} SELECT * FROM both_feeds",
    "mart_increment": _TWICE_SYNCED,
    "log_claims": f"""WITH {_LOGS}, {_LAST_READY}
    SELECT file_log_id, config_id, strftime(create_time, {_STAMP}) AS create_time, file_path, count, file_size,
      CASE WHEN {_CLAIMED} THEN '{D.AS_OF}' ELSE strftime(update_at, {_STAMP}) END AS update_at,
      CASE WHEN {_CLAIMED} THEN 'L_P' ELSE status END AS status FROM logs, last""",
    "ready_file_today": f"""WITH {_LOGS}, {_LAST_READY}
    SELECT config_id, c_name AS process_name, file_log_id, file_path FROM logs JOIN last ON {_CLAIMED}
    JOIN customer ON config_id = c_custkey ORDER BY file_log_id LIMIT 1""",
    "csv_escapes": _texts("CASE WHEN doc_id % 10 <> 0 THEN text || '\\N \"x\\\"' || chr(13) || chr(10) || chr(9) END"),
    "csv_line_breaks": _texts("text || '\\N \"x\\\"' || chr(10) || chr(10) || chr(9) || ',' || chr(10)"),
    "staging_reload": _FEED_ROWS["b"],
    "staging_append": _union_feeds(),
    "load_two_feeds": f"{_TWO_FEEDS} SELECT * FROM both_feeds",
    "check_dimension_keys": f"""{_TWO_FEEDS} SELECT versions, COUNT(*) AS keys FROM (
      SELECT COUNT(*) AS versions FROM both_feeds WHERE NOT isDelete AND product_name IS NOT NULL
        AND manufacturer IS NOT NULL GROUP BY product_name, manufacturer) GROUP BY versions""",
    "dedup_collated": (
        "SELECT MIN(p_partkey) AS p_partkey FROM part GROUP BY"
        " lower(strip_accents(rtrim(p_name))), lower(strip_accents(rtrim(p_brand)))"
    ),
    "parse_size_ignore_case": _parsed("a", "length, width, height"),
    "date_dim_copy": _DATE_DIM,
    "ready_file": f"""WITH {_LOGS}, last AS (SELECT create_time AS t, config_id AS c FROM logs WHERE status = 'C_SE'
      ORDER BY create_time DESC, config_id DESC LIMIT 1)
    SELECT config_id, c_name AS process_name, file_log_id, file_path FROM logs JOIN last ON config_id = c
      AND CAST(create_time AS DATE) = CAST(t AS DATE) JOIN customer ON config_id = c_custkey
    WHERE status = 'C_SE' ORDER BY file_log_id LIMIT 1""",
    "spec_shape": (
        "SELECT c_custkey, CASE WHEN ok THEN 'i' END AS instance, CAST(CASE WHEN ok THEN 2 END AS BIGINT) AS n_fields,"
        " CASE WHEN ok THEN c_name END AS field_name, CASE WHEN ok THEN c_mktsegment END AS selector"
        " FROM (SELECT *, c_custkey % 10 <> 0 AS ok FROM customer)"
    ),
    "parse_price_a": _parsed("a", "price"),
    "parse_price_b": _parsed("b", "price"),
    "parse_weight_a": _parsed("a", "weight"),
    "parse_weight_b": _parsed("b", "weight"),
    "parse_size_a": _parsed("a", "length, width, height"),
    "parse_size_b": _parsed("b", "length, width, height"),
    "image_list": _parsed("a", "image"),
    "split_images": (
        f"SELECT k + 1 AS id, CAST(i AS BIGINT) AS n, '{_PREFIX}https://shop/p' || k || '_' || i || '.png' AS url"
        " FROM (SELECT p_partkey AS k, unnest(range(1, 2 + p_partkey % 14)) AS i FROM part)"
    ),
    "dedup_keep_first": _DEDUP,
    "drop_incomplete": _with(
        None, "SELECT id, product_name, price FROM typed WHERE product_name IS NOT NULL AND price IS NOT NULL"
    ),
    "stage_feed_a": _with("stg", f"SELECT {_STG_COLUMNS} FROM stg"),
    "stage_feed_b": _with("stg", f"SELECT {_STG_COLUMNS} FROM stg", "b"),
    "union_feeds": _union_feeds(),
    "scd2_current": _with(
        "dim", f"SELECT id, product_name, manufacturer, price, expired_date FROM dim d WHERE {_CURRENT}"
    ),
    "new_products": _with("fresh", "SELECT id, product_name, manufacturer, price FROM fresh"),
    "changed_products": _with("changed", "SELECT id, product_name, manufacturer, price, sensor FROM changed"),
    "expire_ids": _with("ids", "SELECT id FROM ids"),
    "scd2_expire": _with("loaded", "SELECT id, isDelete, date_delete, expired_date FROM loaded"
                         " WHERE id IN (SELECT id FROM dim)"),
    "scd2_load": _with("loaded", "SELECT * FROM loaded"),
    "mart_update": _with("updated", "SELECT * FROM updated"),
    "mart_insert": _with("dw", _not_in("mart")),
    "mart_delete": _with("dw", _without_deleted("mart")),
    "mart_sync": _with("synced", _without_deleted("synced")),
    "pipeline_feed_a": _with("synced", _without_deleted("synced")),
    "pipeline_feed_b": _with("synced", _without_deleted("synced"), "b"),
    "date_dim": _DATE_DIM,
    "date_fk": _DATE_FK,
    "ready_files": _READY,
    "logs_on_day": (
        f"WITH {_LOGS} SELECT file_log_id, config_id, status FROM logs WHERE CAST(create_time AS DATE) = DATE '{DAY}'"
    ),
    "log_by_id": f"WITH {_LOGS} SELECT {_LOG_TEXT} FROM logs WHERE file_log_id = 1",
    "run_guard": (
        "SELECT c_custkey AS config_id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey"
        f" AND CAST(o_orderdate AS DATE) = DATE '{DAY}') AS already_run FROM customer"
    ),
    "log_insert": _INSERT,
    "log_update": _UPDATE,
    "run_report": _REPORT,
    "file_paths": (
        "SELECT o_orderkey, '/data/' || o_orderpriority || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv'"
        " AS file_path FROM orders"
    ),
    "csv_roundtrip": (
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment, n AS written, n AS ids,"
        " CAST(n * (n + 1) // 2 AS BIGINT) AS id_sum FROM customer, (SELECT COUNT(*) AS n FROM customer)"
    ),
    "file_stats": (
        "SELECT COUNT(*) AS rows, CAST(SUM(b) AS BIGINT) AS bytes, CAST(ceil(SUM(b) / 1024) AS BIGINT) AS size_kb"
        " FROM (SELECT octet_length(encode(c_name || ', ' || c_mktsegment)) + 1 AS b FROM customer)"
    ),
    "html_extract_fields": _HTML_FIELDS,
    "html_nested_fields": f"""SELECT page_id, url, title, CASE WHEN ad0 THEN trim('in deep er ' || ad)
      || CASE WHEN page_id % 2 = 0 THEN ', deep' ELSE '' END ELSE '' END AS ad,
      CASE WHEN ad0 THEN trim('in deep er ' || ad) ELSE ad_by_sibling END AS ad_by_sibling
    FROM ({_HTML_FIELDS}) JOIN (SELECT page_id, contains(html, '<div class="ad">') AS ad0 FROM pages) USING (page_id)""",
    "html_extract_links": _LINKS,
    "html_listing_links": _LISTING,
    "html_compose": _COMPOSE,
    "absolutize_urls": _ABSOLUTE,
    "spec_from_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "check_fk": (
        "SELECT event_id, user_id, event_type FROM events"
        " WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)"
    ),
    "check_unique": "SELECT p_name, p_brand, COUNT(*) AS n FROM part GROUP BY p_name, p_brand HAVING COUNT(*) > 1",
    "check_domain": (
        "SELECT o_orderkey, 'domain:o_orderstatus' AS rule FROM orders WHERE o_orderstatus NOT IN ('O', 'F')"
        " UNION ALL SELECT o_orderkey, 'null:o_orderdate' FROM orders WHERE o_orderdate IS NULL"
        " UNION ALL SELECT o_orderkey, 'null:o_custkey' FROM orders WHERE o_custkey IS NULL"
        " UNION ALL SELECT o_orderkey, 'length:o_orderpriority' FROM orders WHERE length(o_orderpriority) > 8"
    ),
}
