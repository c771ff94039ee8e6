"""The pipeline's tables: replaced and extended so that readers see whole states only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.sources.versions import Folder, Table


def read(spark: SparkSession, path: str) -> DataFrame:
    """A table of this module, or a plain Parquet folder or file."""
    if Folder(spark, path).versions():
        return Table(spark, path).read()
    return spark.read.parquet(path)


def reload(df: DataFrame, path: str) -> DataFrame:
    """Empty the table and fill it with ``df``; returns the stored table.

    ``df`` is written beside what is there and then takes its place in one step, so it may
    read the table itself, and a failed reload leaves the table as it was.
    """
    return Table(df.sparkSession, path).replace(df)


def append(df: DataFrame, path: str) -> DataFrame:
    return Table(df.sparkSession, path).append(df)


def copy_table(spark: SparkSession, source: str, target: str, columns: list[str] | None = None) -> DataFrame:
    """Copy a table, e.g. the date dimension from staging to the warehouse."""
    df = read(spark, source)
    return reload(df.select(*columns) if columns else df, target)
