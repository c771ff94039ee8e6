"""CSV files of a feed: config-driven load, positional columns, export, statistics."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.operators.lookup import fits
from shelfmark.operators.ranking import running_totals
from shelfmark.schemas import DATE_DIM_SCHEMA
from shelfmark.session import settle

# Dialect of a feed file; a config row may override each of them.
DIALECT = {
    "fields_terminated_by": ",",
    "optionally_enclosed_by": '"',
    "escaped_by": "\\",
    "lines_terminated_by": "\n",
    "ignore_rows": 1,
}
NULL_TEXT = "\\N"
#: Holds the line of a record that does not have the columns of its config row.
_BAD = "_bad_record"


def map_columns(staging_fields: str | Sequence[str]) -> list[str]:
    """Column names, in file order, from a config row's comma-separated list."""
    if isinstance(staging_fields, str):
        return [name for name in re.split(r",\s*", staging_fields.strip()) if name]
    return list(staging_fields)


def _unescape(text: str) -> str:
    return text.replace("\\r", "\r").replace("\\n", "\n").replace("\\t", "\t")


#: Escapes of a feed file: what stands in a text, and what the file has for it.
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\0", "\\0"))


def _escaped(text: Column) -> Column:
    """Line breaks and backslashes as escapes, so that a record is one line."""
    for raw, shown in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(shown))
    return text


def _read_escapes(text: Column) -> Column:
    """The text that an escaped one stands for; a backslash before any other character goes."""

    def between(part: Column) -> Column:
        for raw, shown in ESCAPES[1:]:
            part = F.replace(part, F.lit(shown), F.lit(raw))
        return F.replace(part, F.lit("\\"), F.lit(""))

    # doubled backslashes part the text, so no other escape can begin in one
    plain = F.array_join(F.transform(F.split(text, r"\\\\", -1), between), "\\")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def _dialect(config: Mapping[str, Any]) -> dict[str, Any]:
    return {**DIALECT, **{k: v for k, v in config.items() if k in DIALECT and v is not None}}


def csv_options(config: Mapping[str, Any]) -> dict[str, str]:
    """How one record is parsed."""
    dialect = _dialect(config)
    quote = dialect["optionally_enclosed_by"]
    return {
        "sep": _unescape(dialect["fields_terminated_by"]),
        "quote": quote,
        "escape": quote or "\\",
        "lineSep": _unescape(dialect["lines_terminated_by"]),
        # line breaks inside quotes stay as they are
        "multiLine": "true",
        # what the parser takes for a missing value, that is, also a field of no characters
        "nullValue": "\0",
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
    }


def load_csv(
    spark: SparkSession, path: str | list[str], config: Mapping[str, Any], numbered: bool = True, file_column: str | None = None
) -> DataFrame:
    """All-text rows of the files under ``path``, read the way ``config`` says.

    ``config`` is a row of the config table (or a dict): field and line terminators,
    optional quote, escape, records to skip per file, and the column list. With
    ``numbered`` an ``id`` counts the rows 1, 2, ... in file order, as the staging key does.

    A file is read in blocks by many tasks, line by line; a record may be several lines, as
    line breaks inside quotes belong to the text. A line begins a record if the quotes
    before it in its file are even in number. So quotes are counted per block, a running
    parity over the blocks says whether a block begins inside quotes, and only the lines of
    records that are not whole are brought together. Blank lines between records are left.
    Where no line has an odd number of quotes, every line is a record and nothing is moved:
    the only thing ordered globally is one row per block.

    ``\\N`` is NULL, and a backslash escapes line breaks and itself, as ``export_csv``
    writes them; an empty ``escaped_by`` takes backslashes as they are. A record with more
    or fewer fields than columns fails the job that reads it, a file that ends inside
    quotes (a stray quote does that) this call.
    """
    columns = map_columns(config["staging_fields"])
    dialect = _dialect(config)
    skip, quote = int(dialect["ignore_rows"]), dialect["optionally_enclosed_by"]
    lines = spark.read.option("lineSep", _unescape(dialect["lines_terminated_by"])).text(path)
    odd = F.char_length("value") - F.char_length(F.replace("value", F.lit(quote), F.lit(""))) if quote else F.lit(0)
    lines = lines.select(
        "value",
        (odd % 2).alias("_odd"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    blank = F.trim("value") == ""
    filled = lines.where(~blank).withColumn("_seq", F.monotonically_increasing_id())
    blocks = settle(
        filled.groupBy("_file", "_start").agg(F.count("*").alias("_rows"), F.sum("_odd").alias("_odd"), F.min("_seq").alias("_first")),
        "blocks",
    )
    files = blocks.groupBy("_file").agg(F.sum("_odd").alias("_odd"))
    open_file = F.max(F.when(F.col("_odd") % 2 == 1, F.col("_file")))
    found = files.agg(open_file.alias("cut"), F.sum("_odd").alias("odd")).first()
    if found["cut"] is not None:
        raise BadFile(f"{found['cut']} ends inside quotes")
    if not found["odd"]:
        records = filled
    else:
        records, blocks = _whole_records(lines, blank, blocks, _unescape(dialect["lines_terminated_by"]))
    return _parsed(_placed(records, blocks, skip), columns, config, numbered, file_column)


class BadFile(ValueError):
    """A file that is not what its dialect says."""


def _whole_records(lines: DataFrame, blank: Column, blocks: DataFrame, line_break: str) -> tuple[DataFrame, DataFrame]:
    """Records of one or several lines, with blocks counted in records."""
    block = ["_file", "_start"]
    earlier = W.partitionBy("_file").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    inside = blocks.withColumn("_inside", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2).select(*block, "_inside")
    # settled, as the places of the lines go into two jobs
    placed = settle(lines.withColumns({"_seq": F.monotonically_increasing_id(), "_blank": blank}), "lines")
    before = W.partitionBy(*block).orderBy("_seq").rowsBetween(W.unboundedPreceding, -1)
    known = placed.join(F.broadcast(inside) if fits(inside) else inside, block, "left")
    quoted = (F.coalesce("_inside", F.lit(0)) + F.coalesce(F.sum("_odd").over(before), F.lit(0))) % 2 == 1
    told = known.withColumn("_quoted", quoted).where("_quoted OR NOT _blank")
    begins = (~F.col("_quoted")).cast("long")
    told = settle(told.withColumn("_record", F.sum(begins).over(before.rowsBetween(W.unboundedPreceding, 0))), "lines")
    counted = settle(
        told.groupBy(*block).agg(F.sum(begins).alias("_rows")).where("_rows > 0").withColumn("_first", F.lit(0).cast("long")), "blocks"
    )
    alone = F.expr("NOT _quoted AND _odd = 0")
    single = told.where(alone).select("value", *block, (F.col("_record") - 1).alias("_seq"))
    # a part of a block's first record begins in an earlier block: the last that has records
    starts = told.where(~alone).select(*block).distinct()
    latest = W.partitionBy("_file").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    owners = (
        starts.join(counted.select(*block, "_rows"), block, "full")
        .withColumn("_owner", F.last(F.when(F.col("_rows").isNotNull(), F.struct("_start", "_rows")), ignorenulls=True).over(latest))
        .select(*block, "_owner")
    )
    parts = told.where(~alone).join(F.broadcast(owners) if fits(owners) else owners, block)
    carried = F.col("_record") == 0
    joined = (
        parts.select(
            "_file",
            F.when(carried, F.col("_owner._start")).otherwise(F.col("_start")).alias("_at"),
            F.when(carried, F.col("_owner._rows")).otherwise(F.col("_record")).alias("_record"),
            F.struct("_start", "_seq", "value").alias("_line"),
        )
        .groupBy("_file", "_at", "_record")
        .agg(F.array_sort(F.collect_list("_line")).alias("_lines"))
        .select(
            F.array_join(F.transform("_lines", lambda x: x["value"]), line_break).alias("value"),
            "_file",
            F.col("_at").alias("_start"),
            (F.col("_record") - 1).alias("_seq"),
        )
    )
    return single.union(joined), counted


def _placed(records: DataFrame, blocks: DataFrame, skip: int) -> DataFrame:
    """Records with ``_file``, ``id`` over all files, and ``_kept``, false for the first
    ``skip`` records of a file."""
    block = ["_file", "_start"]
    offsets = running_totals(blocks, block, "_rows").withColumnRenamed("_before", "_offset")
    # the records to skip that come before this block, and where its file begins
    files = blocks.groupBy("_file").agg(F.sum("_rows").alias("_all"))
    skipped = running_totals(files.withColumn("_out", F.least("_all", F.lit(skip))), ["_file"], "_out")
    begins = offsets.groupBy("_file").agg(F.min("_offset").alias("_file_offset"))
    table = settle(offsets.join(begins, "_file").join(skipped.select("_file", F.col("_before").alias("_skipped")), "_file"), "offsets")
    # one row per file block: a block is one task's rows, which a plain join can shuffle too
    located = records.join(F.broadcast(table) if fits(table) else table, block)
    row = F.col("_offset") + F.col("_seq") - F.col("_first")
    return located.select(
        "value",
        "_file",
        (row - F.col("_skipped") - skip + 1).cast("long").alias("id"),
        (row - F.col("_file_offset") >= skip).alias("_kept"),
    )


def _parsed(records: DataFrame, columns: list[str], config: Mapping[str, Any], numbered: bool, file_column: str | None) -> DataFrame:
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, _BAD])
    # a generator, as it parses once, and keeps the check below from moving before the skipping
    fields = F.from_csv("value", schema, csv_options(config))
    parsed = records.select("_file", "id", F.explode(F.filter(F.array(F.when(F.col("_kept"), fields)), lambda r: r.isNotNull())).alias("_r"))
    bad = F.concat(F.lit("fields do not match the columns: "), F.col(f"_r.{_BAD}"))
    checked = parsed.where(F.when(F.col(f"_r.{_BAD}").isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.lit(True)))
    escapes = bool(_dialect(config)["escaped_by"])

    def text(column: str) -> Column:
        # a field of no characters is an empty text, only \N is NULL, where there are escapes
        found = F.coalesce(F.col(f"_r.`{column}`"), F.lit(""))
        return F.when(found != NULL_TEXT, _read_escapes(found)) if escapes else found

    fields = [text(c).alias(c) for c in columns]
    number = [F.col("id")] if numbered else []
    place = [F.col("_file").alias(file_column)] if file_column else []
    return checked.select(*number, *fields, *place)


def load_date_dim(spark: SparkSession, path: str) -> DataFrame:
    """Date dimension from CSV: every field quoted, no header."""
    options = {"sep": ",", "quote": '"', "escape": '"', "header": "false"}
    return spark.read.schema(DATE_DIM_SCHEMA).options(**options).csv(path)


def export_csv(df: DataFrame, path: str) -> int:
    """Write ``df`` with a header and every field quoted; returns the rows written.

    The count is observed by the writing job itself, not by a second pass.
    """
    written = Observation("csv_export")
    texts = df.select(*[F.coalesce(_escaped(F.col(c).cast("string")), F.lit(NULL_TEXT)).alias(c) for c in df.columns])
    (
        texts.observe(written, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .options(header="true", quoteAll="true", quote='"', escape='"', emptyValue="", encoding="UTF-8")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path)
    )
    return int(written.get["rows"])


def folder_size(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``files`` and ``bytes`` of what lies under ``path``.

    The listing is a distributed table; neither contents nor names come to the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def file_stats(rows: DataFrame, path: str) -> DataFrame:
    """One row: the number of ``rows``, and ``files``, ``bytes`` and ``size_kb`` (rounded up)
    of the folder they were read from. Files without rows count too."""
    size = folder_size(rows.sparkSession, path).withColumn("rows", F.lit(0).cast("long"))
    counted = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.lit(0).cast("long").alias(c) for c in ("files", "bytes")])
    both = counted.unionByName(size).agg(*[F.sum(c).alias(c) for c in ("rows", "files", "bytes")])
    return both.withColumn("size_kb", F.ceil(F.col("bytes") / 1024))
