"""Feeds, warehouse and mart states derived by Spark from the given tables.

``part`` supplies the products: every row becomes one row of each shop feed, with
its attributes written the way the shops write them. All numbers come from the part
key by integer arithmetic, so the expected values are known without any parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.staging import dedup_keep_first, drop_incomplete, stage_feed, to_typed
from shelfmark.schemas import DIMENSION_SCHEMA, MART, NEVER
from shelfmark.session import settle

CREATED = "2024-11-03 00:00:00"
AS_OF = "2024-11-04 00:00:00"
CALENDAR = ("2005-01-01", "2026-12-31")

# Text of a size and the length, width and height it stands for. In the text, {l},
# {w}, {h} are millimetres, {lc}... centimetres, a trailing comma a decimal comma.
# In the result, "l" is the value in millimetres, "l|" what is left of it when the
# comma ends the number, "lc|" the same for centimetres, "lc" centimetres unscaled.
Template = tuple[str | None, tuple[str | None, str | None, str | None]]

SIZE_TEXTS_A: tuple[Template, ...] = (
    ("{lc,} x {wc} x {hc} cm", ("l", "w", "h")),
    ("Cao: {l} mm x Rộng: {w} mm x Dày: {h} mm", ("l", "h", "h")),
    ("{l,} x {w} x {h} mm", ("l|", "w", "h")),
    ("{l} x {w,} x {h,}mm", ("l", "w|", "h")),
    ("Dài: {l}mm | Rộng: {w,} mm | Cao: {h} mm", ("l", "w|", "h")),
    ("{l} x {w} x {h,} mm (Cao x Rộng x Dày)", ("l", "w", "h|")),
    ("{l}x{w}x{h}mm", ("l", "w", "h")),
    ("Cao {l} mm x Rộng {w} mm x Dày {h} mm", ("l", "w", "h")),
    ("{l} mm x {w} mm x {h} mm", ("l", "w", "h")),
    ("{lc,} x {wc} x {hc}cm", ("lc|", "w", "h")),
    ("{l,} x {w} x {h} mm (Dài x Rộng x Cao)", ("l", "w", "h")),
    ("{l}mm * {w,}mm * {h}mm", ("l", "w", "h")),
    ("{l}mm * {w}mm * {h}mm;", ("l", "w", "h")),
    ("{l} ×{w} ×{h,} mm", ("l", "w", "h")),
    (
        "- Bàn phím: Dài 44 cm - ngang 13 cm - cao 2 cm - Chuột: Dài {lc,} cm - ngang {wc,} cm - cao {hc} cm",
        ("l", "wc|", "hc"),
    ),
    ("{l} x {w} x{h} mm", ("l", "w", "h")),
    ("{l} × {w,} × {h} mm", ("l", "w|", "h")),
    ("{hc}cm × {wc}cm × {lc}cm", ("l", "w", "h")),
    ("{l}*{w}*{h,}mm", ("l", "w", "h|")),
    ("{l} x{w} x {h} mm", ("l", "w", "h")),
    ("Dài: {lc}cm Cao : {hc} cm Rộng : {wc,}cm", ("l", "w", "hc")),
    ("Dài {lc} cm - ngang {wc} cm - cao {hc,} cm Độ dài dây: 1.8 m", ("l", "w", "hc|")),
    ("Cao {l} mm x Rộng {w} mm x Sâu {h,} mm", ("l", "w", "h")),
    ("4.9 x 2.5 x 1.6 in ({l} x {w,} x {h} mm)", ("l", "w", "h")),
    ("Cao {lc}cm x Rộng {wc}cm x Dày {hc,}cm", ("l", "w", "h")),
    ("{lc}x{wc}x{hc}cm", ("l", "w", "h")),
    ("Chuột : Dài: {lc}cm, Cao : {hc,} cm, Rộng : {wc}cm", ("l", "w", "hc")),
    ("{lc,} x {wc} x {hc} cm (4.9 x 2.5 x 1.6 in)", ("lc|", "w", "h")),
    ("dùng pin AA", (None, None, None)),
    ("  {l} x {w} x {h} mm ", ("l", "w", "h")),
    ("", (None, None, None)),
    (None, (None, None, None)),
)

SIZE_TEXTS_B: tuple[Template, ...] = (
    ("Dài {l} x Rộng {w} x Cao {h}", ("l", "w", "h")),
    ("{l} x {w} x {h} mm", ("l", "w", "h")),
    ("{lc} x {wc} x {hc} cm", ("l", "w", "h")),
    ("{lc}x{wc}x{hc}cm", ("l", "w", None)),
    ("{l} mm x {w} mm x {h} mm", ("l", "w", "h")),
    ("{l}*{w}*{h}mm", ("l", "w", "h")),
    ("{lc,} x {wc,} x {hc} cm", ("l", "w", "h")),
    ("{l,} x {w,} x {h} mm", ("l", "w", "h")),
    ("{l} x 50.2 x 30.3mm, 90.1 x {w,} x {h}mm", ("l", "w", "h")),
    ("Chiều cao: {l,} mm, Chiều rộng: {w,} mm, Chiều dày: {h,} mm, Trọng lượng: 90 g", ("l", "w", "h")),
    ("{l} x {w} x {h} ( mm ) ( Dài x Rộng x Cao )", ("l", "w", "h")),
    ("{l}(L)x{w}(w)x{h,}(H) mm", ("l", "w", "h")),
    ("{l}(L) x {w}(W) x {h}(H) mm", ("l", "w", "h")),
    ("\u200e{lc} x {wc,} x {hc} cm", ("l", "w", "h")),
    ("({l}) x {w} x {h} ( mm ) ( Dài x Rộng x Cao )", ("l", None, None)),
    ("({l} x {w,} x {h} ( mm ) ( Dài x Rộng x Cao )", ("l", "w|", "h")),
    ("{l} x {w} x {h} (mm)", ("l", "w", "h")),
    ("{l} x 50.2 x 30.3 mm, 90.1 x {w} x {h} mm", ("l", "w", "h")),
    ("{l} x 50.2 x 30.3 mm, 80 x 40 x 20 mm, 90.1 x {w} x {h} mm", ("l", "w", "h")),
    ("{l,} mm x {w,} mm x {h,} mm", ("l", "w", "h|")),
    ("{l} (dài) x {w} (rộng) x {h} mm (cao)", ("l", "w", "h")),
    ("Length: {l} mm / 4.94 in, Width: {w} mm / 2.49 in, Height: {h} mm / 1.64 in", ("l", "w", "h")),
    ("Dài: {l} mm / 4.94 in, Rộng: {w} mm / 2.49 in, Cao: {h} mm / 1.64 in", ("l", "w", "h")),
    (
        "Chiều dài: {l,} mm / 4,94 inch Chiều rộng: {w,} mm / 2,49 inch Chiều cao: {h,} mm / 1,64 inch",
        ("l", "w|", "h"),
    ),
    (" {l}x{w}x{h}mm", (None, None, "h")),
    ("không rõ", (None, None, None)),
    (None, (None, None, None)),
)

# Text of a weight and its value: {g} grams, {kg} the same number as hundredths of a
# kilogram. The value is in tenths of a gram, as (factor, summand) of g.
Weight = tuple[str, tuple[int, int] | None]

WEIGHT_TEXTS_A: tuple[Weight, ...] = (
    ("{g} g", (10, 0)),
    ("{kg} kg", (100, 0)),
    ("{g}g", None),
    ("{g}.5 g", (10, 5)),
    ("", None),
)
WEIGHT_TEXTS_B: tuple[Weight, ...] = (
    ("{g} g", (10, 0)),
    ("<{g}g", (10, 0)),
    ("{g} g (thêm)", (10, 0)),
    ("{g} g / 3,56 oz", (10, 0)),
    ("< {g} g", (10, 0)),
    ("{g},4 g - pin", (10, 4)),
    ("POWERPLAY {g}g / Pin AA 86g", (10, 0)),
    ("0.5 kg", (0, 5)),
    ("nhẹ", None),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quoted(text: str | None) -> str:
    return "CAST(NULL AS STRING)" if text is None else "r'" + text + "'"


def _pick(texts: list[str | None]) -> str:
    return f"get(array({', '.join(_quoted(t) for t in texts)}), CAST(k % {len(texts)} AS INT))"


def _fill(text: str, values: dict[str, str]) -> str:
    for name, value in values.items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return text


def _numbers(name: str) -> dict[str, str]:
    """SQL texts of a length given in tenths of a millimetre, by placeholder."""
    mm = f"concat({name} div 10, '.', {name} % 10)"
    cm = f"concat({name} div 100, '.', lpad({name} % 100, 2, '0'))"
    return {
        name: mm,
        f"{name},": f"translate({mm}, '.', ',')",
        f"{name}c": cm,
        f"{name}c,": f"translate({cm}, '.', ',')",
    }


def raw_feed(part: DataFrame, feed: str) -> DataFrame:
    """All-text staging rows of feed ``a`` or ``b``, one per part."""
    sizes = [text for text, _ in (SIZE_TEXTS_A if feed == "a" else SIZE_TEXTS_B)]
    weights = [text for text, _ in (WEIGHT_TEXTS_A if feed == "a" else WEIGHT_TEXTS_B)]
    if feed == "a":
        price = "CASE WHEN k % 11 = 0 THEN 'Giá Liên Hệ' ELSE concat(t, '.000đ') END"
    else:
        price = (
            "CASE WHEN k % 11 = 0 THEN '' WHEN k % 5 = 0 THEN concat('1.', t, '.000₫') ELSE concat(t, '.000₫') END"
        )
    url = "concat('https://cdn/insecure/q:90/plain/https://shop/p', k, '_', i, '.png')"
    numbers = part.selectExpr(
        "p_partkey AS k",
        "p_name",
        "p_brand",
        "50 + p_partkey % 70 AS g",
        "100 + p_partkey % 900 AS t",
        "1000 + p_partkey % 300 AS l",
        "550 + p_partkey % 150 AS w",
        "300 + p_partkey % 130 AS h",
    )
    return numbers.selectExpr(
        "k + 1 AS id",
        "p_name AS name",
        "CASE WHEN k % 37 = 0 THEN NULL ELSE p_brand END AS brand",
        f"{price} AS price",
        f"{_fill(_pick(sizes), {**_numbers('l'), **_numbers('w'), **_numbers('h')})} AS size",
        _fill(_pick(weights), {"g": "CAST(g AS STRING)", "kg": "concat(g div 100, '.', lpad(g % 100, 2, '0'))"})
        + " AS weight",
        "concat(100 * (k % 9 + 1), ' dpi') AS dpi",
        "concat('S', k % 7) AS sensor",
        "concat('C', k % 3) AS connector",
        "concat('B', k % 4) AS pin",
        "concat('O', k % 5) AS os",
        f"array_join(transform(sequence(1L, 1 + k % 14), i -> {url}), ', ') AS images",
        f"TIMESTAMP_NTZ'{CREATED}' AS created_at",
    )


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return raw_feed(table(spark, sf_dir, "part"), feed)


def typed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return to_typed(raw(spark, sf_dir, feed), feed)


def staged(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return stage_feed(raw(spark, sf_dir, feed), feed)


def warehouse(all_rows: DataFrame, current: DataFrame) -> DataFrame:
    """The dimension before the load: an earlier version of the staged rows.

    Copies that staging drops are past versions. One brand is not carried yet, one
    battery type was cheaper, one connection has no sensor recorded, and products
    for one platform were withdrawn.
    """
    ended, withdrawn = F.lit("2024-06-30").cast("date"), F.lit("2024-10-01").cast("date")
    gone = F.col("compatibility") == "O4"
    now = current.withColumns(
        {
            "isDelete": gone,
            "date_delete": F.when(gone, withdrawn),
            "expired_date": F.when(gone, withdrawn).otherwise(F.lit(NEVER).cast("date")),
            "price": F.when(F.col("battery") == "B1", F.col("price") - 1000).otherwise(F.col("price")),
            "sensor": F.when(F.col("connectivity") == "C2", F.lit(None)).otherwise(F.col("sensor")),
        }
    )
    past = all_rows.join(current.select("id"), "id", "left_anti").withColumns(
        {"isDelete": F.lit(True), "date_delete": ended, "expired_date": ended}
    )
    versions = now.unionByName(past).withColumns(
        {
            "date_insert": F.col("created_at"),
            "date_insert_fk": F.when(F.col("battery") != "B3", F.lit(7247)),
        }
    )
    carried = versions.filter(F.col("manufacturer").isNull() | (F.col("manufacturer") != "Brand#7"))
    return carried.select(*[F.col(f.name).cast(f.dataType) for f in DIMENSION_SCHEMA])


def states(spark: SparkSession, sf_dir: str, feed: str) -> tuple[DataFrame, DataFrame]:
    """Staged batch and dimension before the load, as written tables.

    Both come from one parse of the feed; in a warehouse they are tables as well.
    """
    all_rows = settle(typed(spark, sf_dir, feed))
    batch = settle(drop_incomplete(dedup_keep_first(all_rows)))
    return batch, settle(warehouse(all_rows, batch))


def mart(dim: DataFrame) -> DataFrame:
    """The mart before the sync: what was on sale, except for the small products."""
    on_sale = F.col("expired_date") > F.lit("2024-06-30").cast("date")
    shown = F.col("manufacturer").isNotNull() & ~F.col("product_name").startswith("small ")
    return dim.filter(on_sale & shown).select(*MART)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the load log."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "C_SE").when(F.col("o_orderstatus") == "O", "C_E").otherwise("C_FE")
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("file_log_id"),
        F.col("o_custkey").alias("config_id"),
        F.col("o_orderdate").alias("create_time"),
        F.format_string("/data/feed_%d_%s.csv", "o_custkey", day).alias("file_path"),
        F.floor("o_totalprice").alias("count"),
        F.ceil(F.col("o_totalprice") / 1024).cast("decimal(10,2)").alias("file_size"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 MINUTES")).alias("update_at"),
        status.alias("status"),
    )


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as feed configurations."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("config_id"),
        F.col("c_name").alias("process_name"),
        F.lower("c_mktsegment").alias("file_name"),
    )
