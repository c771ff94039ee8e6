"""Load log: which file is ready, what ran, and how it ended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.lookup import fits, lookup
from shelfmark.operators.ranking import number_rows
from shelfmark.schemas import LOG_STATES

# Allowed moves between log states, the text of a state in a report,
# the pattern of a report time.
MOVES = {"C_E": ("C_SE", "C_FE"), "C_SE": ("L_P",), "L_P": ("L_SE", "L_FE")}
STATE_TEXT = {
    "C_E": "Crawling",
    "C_SE": "Crawl Success",
    "C_FE": "Crawl Failure",
    "L_P": "Loading",
    "L_SE": "Load Success",
    "L_FE": "Load Failure",
    "L_CE": "Load Completed",
}
REPORT_TIME = "dd/MM/yyyy - hh:mm:ss a"


class MissingInput(RuntimeError):
    """No file or row is there to be processed."""


class AlreadyRun(RuntimeError):
    """The process has run for this configuration and day."""


class BadTransition(ValueError):
    """A log row was asked to move to a state its own state does not lead to."""


def on_day(df: DataFrame, ts: str, day: str | None = None) -> DataFrame:
    """Rows of one calendar day (default: today).

    A half-open range on the bare column, which Parquet can use to skip row groups;
    a function of the column could not be pushed down.
    """
    start = F.current_date() if day is None else F.lit(day).cast("date")
    low, high = start.cast("timestamp_ntz"), F.date_add(start, 1).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= low) & (F.col(ts) < high))


def by_id(df: DataFrame, key: str, value: int) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def ready_file(
    logs: DataFrame, configs: DataFrame, config_id: int, day: str | None = None, day_column: str = "create_time"
) -> DataFrame:
    """The one file of a configuration to load on a day, with its CSV settings."""
    ready = on_day(logs, day_column, day).filter((F.col("status") == "C_SE") & (F.col("config_id") == config_id))
    return ready.join(configs, "config_id").orderBy("file_log_id").limit(1)


def ready_files(logs: DataFrame, configs: DataFrame, day_column: str = "create_time") -> DataFrame:
    """That file for every configuration and day: the ready one with the lowest id."""
    ready = logs.filter(F.col("status") == "C_SE").withColumn("day", F.to_date(day_column))
    lowest = ready.groupBy("config_id", "day").agg(F.min("file_log_id").alias("file_log_id")).select("file_log_id")
    first = ready.join(lowest, "file_log_id", "left_semi").select("config_id", "day", "file_log_id", "file_path")
    return lookup(first, configs, ["config_id"], "inner", "file_log_id", small=fits(configs))


def require_rows(df: DataFrame, message: str = "File path is NULL or no file with C_SE status") -> DataFrame:
    if df.isEmpty():
        raise MissingInput(message)
    return df


def already_run(logs: DataFrame, config_id: int, day: str | None = None) -> bool:
    return not on_day(logs.filter(F.col("config_id") == config_id), "create_time", day).isEmpty()


def require_not_run(logs: DataFrame, config_id: int, day: str | None = None) -> None:
    if already_run(logs, config_id, day):
        raise AlreadyRun(f"configuration {config_id} has run on {day or 'the current day'}")


def run_guard(logs: DataFrame, configs: DataFrame, day: str | None = None) -> DataFrame:
    """``already_run`` for all configurations at once."""
    ran = on_day(logs, "create_time", day).groupBy("config_id").agg(F.lit(True).alias("_ran"))
    return configs.join(ran, "config_id", "left").select(
        "config_id", F.coalesce(F.col("_ran"), F.lit(False)).alias("already_run")
    )


def log_insert(logs: DataFrame, rows: DataFrame, as_of: str, order: str = "config_id") -> DataFrame:
    """The log with new rows (config_id, file_path, count, status), ids continued in
    the order of ``order``, a unique column of ``rows``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    top = logs.select(F.coalesce(F.max("file_log_id"), F.lit(0))).scalar()
    added = number_rows(rows, order, top).select(
        F.col("_number").cast("long").alias("file_log_id"),
        F.col("config_id"),
        now.alias("create_time"),
        F.col("file_path"),
        F.col("count").cast("long"),
        F.lit(None).cast("decimal(10,2)").alias("file_size"),
        now.alias("update_at"),
        F.col("status"),
    )
    return logs.select(*added.columns).unionByName(added)


def _allowed(old: Column, new: Column) -> Column:
    pairs = [(o, n) for o, targets in MOVES.items() for n in targets]
    allowed = F.lit(False)
    for o, n in pairs:
        allowed = allowed | ((old == o) & (new == n))
    return allowed


def log_update(logs: DataFrame, updates: DataFrame, as_of: str, check: bool = False) -> DataFrame:
    """Set status, and count and size where given, of the logs named in ``updates``
    (file_log_id, status, optionally count and file_size), one row per id.

    ``check`` makes the job fail on a move that :data:`MOVES` does not list.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    given = updates.select("file_log_id", *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c != "file_log_id"])
    joined = logs.join(given, "file_log_id", "left")
    hit = F.col("_new_status").isNotNull()
    status = F.coalesce(F.col("_new_status"), F.col("status"))
    if check:
        message = F.concat(F.lit("log cannot move from "), F.col("status"), F.lit(" to "), F.col("_new_status"))
        status = F.when(hit & ~_allowed(F.col("status"), F.col("_new_status")), F.raise_error(message)).otherwise(status)
    changes = {"status": status, "update_at": F.when(hit, now).otherwise(F.col("update_at"))}
    for column in ("count", "file_size"):
        if column in updates.columns:
            changes[column] = F.coalesce(F.col(f"_new_{column}"), F.col(column))
    return joined.select(*[changes.get(c, F.col(c)).alias(c) for c in logs.columns])


def transition(logs: DataFrame, file_log_id: int, status: str, as_of: str) -> DataFrame:
    """Move one log row to ``status`` after checking that the move is allowed."""
    if status not in LOG_STATES:
        raise BadTransition(f"unknown state {status}")
    row = by_id(logs, "file_log_id", file_log_id).select("status").first()
    if row is None:
        raise MissingInput(f"no log row {file_log_id}")
    if status not in MOVES.get(row["status"], ()):
        raise BadTransition(f"log {file_log_id} cannot move from {row['status']} to {status}")
    hit = F.col("file_log_id") == file_log_id
    return logs.withColumns(
        {
            "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
            "update_at": F.when(hit, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col("update_at")),
        }
    )


def file_paths(logs: DataFrame, folder: str, name: Column, day: Column) -> DataFrame:
    """Add ``file_path``: ``<folder>/<name>_<yyyy-MM-dd>.csv``."""
    path = F.format_string("%s/%s_%s.csv", F.lit(folder), name, F.date_format(day, "yyyy-MM-dd"))
    return logs.withColumn("file_path", path)


def run_report(logs: DataFrame, configs: DataFrame) -> DataFrame:
    """One readable line per run: process, status, times, note and reason."""
    text = F.lit(None).cast("string")
    for state, words in STATE_TEXT.items():
        text = F.when(F.col("status") == state, words).otherwise(text)
    failed = F.col("status").isin("C_FE", "L_FE")
    note = F.format_string("count: %d, file size: %d kb", "count", F.ceil("file_size").cast("int"))
    names = configs.select("config_id", "process_name")
    return lookup(logs, names, ["config_id"], "inner", "file_log_id", small=fits(names)).select(
        "file_log_id",
        "process_name",
        text.alias("status"),
        F.date_format("create_time", REPORT_TIME).alias("start_time"),
        F.date_format("update_at", REPORT_TIME).alias("end_time"),
        F.when(failed, "None").otherwise(note).alias("note"),
        F.when(failed, text).otherwise("None").alias("reason"),
    )
