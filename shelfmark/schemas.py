"""Column layouts of the tables and the description of each feed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from shelfmark.functions.numbers import MONEY

# CSV column order of the two feeds, the staging column a text column
# becomes, the log states and the "never expires" date.
FEED_A_FIELDS = ("weight", "size", "dpi", "sensor", "connector", "pin", "os", "brand", "name", "price", "images")
FEED_B_FIELDS = ("weight", "brand", "dpi", "size", "sensor", "connector", "os", "pin", "images", "name", "price")
RENAMED = {
    "name": "product_name",
    "images": "image",
    "dpi": "resolution",
    "connector": "connectivity",
    "pin": "battery",
    "os": "compatibility",
    "brand": "manufacturer",
}
LOG_STATES = ("C_RE", "C_E", "C_SE", "C_FE", "L_RE", "L_P", "L_SE", "L_FE", "L_CE")
NEVER = "9999-12-31"

KEYS = ("product_name", "manufacturer")
COMPARED = (
    "price",
    "image",
    "length",
    "width",
    "height",
    "weight",
    "resolution",
    "sensor",
    "connectivity",
    "battery",
    "compatibility",
)
PRODUCT = (
    "product_name",
    "price",
    "image",
    "length",
    "width",
    "height",
    "weight",
    "resolution",
    "sensor",
    "connectivity",
    "battery",
    "compatibility",
    "manufacturer",
)
STAGING = ("id", *PRODUCT, "created_at", "source")
DIMENSION = (*STAGING, "isDelete", "date_delete", "date_insert", "expired_date", "date_insert_fk")
MART = (
    "id",
    "product_name",
    "price",
    "image",
    "weight",
    "resolution",
    "sensor",
    "connectivity",
    "battery",
    "compatibility",
    "manufacturer",
    "length",
    "width",
    "height",
)

_TYPES = {
    "id": T.LongType(),
    "price": MONEY,
    "length": MONEY,
    "width": MONEY,
    "height": MONEY,
    "weight": MONEY,
    "created_at": T.TimestampNTZType(),
    "isDelete": T.BooleanType(),
    "date_delete": T.DateType(),
    "date_insert": T.TimestampNTZType(),
    "expired_date": T.DateType(),
    "date_insert_fk": T.IntegerType(),
}


def _schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns])


STAGING_SCHEMA = _schema(STAGING)
DIMENSION_SCHEMA = _schema(DIMENSION)
MART_SCHEMA = _schema(MART)

_NAMED_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal": T.DecimalType(10, 2),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs, without needing a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _NAMED_TYPES[kind]) for name, kind in pairs])


CONFIG_SCHEMA = _struct(
    "config_id int, save_location string, tble_warehouse string, tble_staging string, url string,"
    " file_name string, schedule bigint, staging_fields string, dw_fields string,"
    " fields_terminated_by string, optionally_enclosed_by string, lines_terminated_by string,"
    " ignore_rows int, staging_table string, property_id int"
)
PROPERTY_SCHEMA = _struct(
    "property_id int, name string, header_csv string, value string, last_modified timestamp_ntz"
)
LOG_SCHEMA = _struct(
    "file_log_id bigint, config_id bigint, create_time timestamp_ntz, file_path string, count bigint,"
    " file_size decimal, update_at timestamp_ntz, status string"
)
DATE_DIM_SCHEMA = _struct(
    "date_sk int, full_date date, day_since_2005 int, month_since_2005 int, day_of_week string,"
    " calendar_month string, calendar_year int, calendar_year_month string, day_of_month int,"
    " day_of_year int, week_of_year_sunday int, year_week_sunday string, week_sunday_start date,"
    " week_of_year_monday int, year_week_monday string, week_monday_start date, holiday string,"
    " day_type string"
)


@dataclass(frozen=True)
class FeedSpec:
    """What differs between two shop feeds."""

    name: str
    source: str
    fields: tuple[str, ...]
    ready_day_column: str  # which log time decides the day a file belongs to


FEEDS = {
    "a": FeedSpec("a", "feed_a", FEED_A_FIELDS, "update_at"),
    "b": FeedSpec("b", "feed_b", FEED_B_FIELDS, "create_time"),
}
