"""Date dimension and the foreign key into it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.lookup import fits, lookup
from shelfmark.schemas import DATE_DIM_SCHEMA

# Day number one and the two labels.
EPOCH = "2005-01-01"
HOLIDAY = "Non-Holiday"
DAY_TYPES = ("Weekday", "Weekend")


def _describe_days(days: DataFrame) -> DataFrame:
    """All columns of the dimension from ``full_date``."""
    d = F.col("full_date")
    day_number = F.datediff(d, F.lit(EPOCH).cast("date")) + 1
    sunday_first = F.dayofweek(d)  # 1 = Sunday
    monday_first = F.weekday(d)  # 0 = Monday
    sunday_week = F.floor((F.dayofyear(d) + 7 - sunday_first) / 7).cast("int")
    monday_week = F.floor((F.dayofyear(d) + 6 - monday_first) / 7).cast("int")

    def year_week(week: Column) -> Column:
        return F.format_string("%d-W%02d", F.year(d), week)

    columns = {
        "date_sk": day_number,
        "full_date": d,
        "day_since_2005": day_number,
        "month_since_2005": (F.year(d) - int(EPOCH[:4])) * 12 + F.month(d),
        "day_of_week": F.date_format(d, "EEEE"),
        "calendar_month": F.date_format(d, "MMMM"),
        "calendar_year": F.year(d),
        "calendar_year_month": F.date_format(d, "yyyy-MMM"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year_sunday": sunday_week,
        "year_week_sunday": year_week(sunday_week),
        "week_sunday_start": F.date_sub(d, sunday_first - 1),
        "week_of_year_monday": monday_week,
        "year_week_monday": year_week(monday_week),
        "week_monday_start": F.date_sub(d, monday_first),
        "holiday": F.lit(HOLIDAY),
        "day_type": F.when(monday_first >= 5, DAY_TYPES[1]).otherwise(DAY_TYPES[0]),
    }
    return days.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in DATE_DIM_SCHEMA])


def date_dim(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return _describe_days(spark.range(1).select(F.explode(days).alias("full_date")))


def date_dim_covering(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last ``ts`` of ``df``."""
    ends = df.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi"))
    return _describe_days(ends.select(F.explode(F.sequence("lo", "hi")).alias("full_date")))


def date_fk(df: DataFrame, calendar: DataFrame, ts: str = "created_at", fk: str = "date_insert_fk") -> DataFrame:
    """Fill ``fk`` where it is NULL with the key of the day of ``ts``.

    Days outside the calendar keep NULL. A load writes all its rows on one day, so a
    shuffle on the day would put them into one task: the calendar, 366 rows a year,
    is counted and broadcast, and only an absurdly long one is joined in slices.
    """
    days = calendar.select(F.col("full_date").alias("_day"), F.col("date_sk").alias("_sk"))
    dated = df.withColumns({"_day": F.to_date(ts), "_row": F.monotonically_increasing_id()})
    joined = lookup(dated, days, ["_day"], "left", "_row", small=fits(days))
    return joined.withColumn(fk, F.coalesce(F.col(fk), F.col("_sk"))).select(*df.columns)
