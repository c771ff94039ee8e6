"""One feed from its pages to a CSV file, and from there to warehouse and mart."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.control import log_insert, log_update, require_not_run, transition
from shelfmark.operators.history import scd2_load
from shelfmark.operators.mart import mart_sync
from shelfmark.operators.staging import stage_feed
from shelfmark.plans.warehouse import Dimension, Log, Mart
from shelfmark.schemas import FEEDS, MART_SCHEMA, FeedSpec
from shelfmark.session import run_folder, settle
from shelfmark.sources.csv_feed import export_csv, folder_size, load_csv
from shelfmark.sources.pages import extract_fields
from shelfmark.sources.tables import read, reload
from shelfmark.sources.versions import Folder


class LoadFailed(RuntimeError):
    """The file could not be loaded; ``log`` is the log with the failed load."""

    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


class ExportFailed(RuntimeError):
    """The pages could not be exported; ``log`` is the log with the failed run."""

    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


def pages_to_csv(
    pages: DataFrame, fields: Sequence[dict[str, str]], path: str, log: Log, config_id: int, as_of: str
) -> DataFrame:
    """Extract the fields of all pages into a feed file; returns the log afterwards.

    Refuses a second run for a configuration and day, also one that starts at the same
    time. The run is logged as started, then as done with its row count and size in KB,
    or as failed.
    """
    spark = pages.sparkSession
    started = spark.createDataFrame(
        [(config_id, path, 0, "C_E")], "config_id bigint, file_path string, count bigint, status string"
    )

    def start(logs: DataFrame) -> DataFrame:
        require_not_run(logs, config_id, as_of[:10])
        return log_insert(logs, started, as_of)

    own = (F.col("config_id") == config_id) & (F.col("status") == "C_E") & (F.col("file_path") == path)
    log_id = log.change(start).where(own).agg(F.max("file_log_id")).first()[0]
    try:
        with run_folder(spark, "export"):
            count = export_csv(extract_fields(pages, fields, keep=[]), path)
        size_kb = folder_size(spark, path).select(F.ceil(F.col("bytes") / 1024)).first()[0]
    except Exception as error:
        raise ExportFailed(str(error), log.move(log_id, "C_FE", as_of)) from error
    done = spark.createDataFrame(
        [(log_id, "C_SE", count, size_kb)], "file_log_id bigint, status string, count bigint, file_size bigint"
    ).withColumn("file_size", F.col("file_size").cast("decimal(10,2)"))
    return log.change(lambda logs: log_update(logs, done, as_of, check=True))


def load_feeds(
    staged: Sequence[DataFrame], dim: DataFrame, calendar: DataFrame, as_of: str
) -> DataFrame:
    """The dimension after loading one staged batch after the other.

    Each feed numbers its rows from 1 and may carry a key that another one has, so the
    batches are not one: every batch is merged into the result of those before it.
    """
    for stg in staged:
        dim = settle(scd2_load(dim, stg, calendar, as_of), "dimension")
    return dim


def run_feed(
    raw: DataFrame,
    feed: FeedSpec | str,
    dim: DataFrame,
    mart: DataFrame,
    calendar: DataFrame,
    as_of: str,
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged batch, dimension and mart after loading ``raw`` on ``as_of``.

    Each stage is settled (written out) because the next one reads it several
    times; nothing but row counts comes to the driver.
    """
    stg = settle(stage_feed(raw, feed, **options))
    loaded = settle(scd2_load(dim, stg, calendar, as_of))
    return stg, loaded, mart_sync(mart, loaded)


@dataclass(frozen=True)
class FeedPaths:
    """Folders of the stored tables of a warehouse; ``runs`` has what unfinished runs made."""

    log: str
    staging: str
    dimension: str
    mart: str
    calendar: str
    runs: str


class Run:
    """What a run has finished, in a versioned folder of its own, so that another can go on."""

    def __init__(self, spark: SparkSession, root: str, as_of: str) -> None:
        self.spark, self.folder = spark, Folder(spark, root)
        if not self.folder.versions():
            self.folder.commit(0, {"as_of": as_of, "stages": {}})
        self.as_of = self.folder.head()[1]["as_of"]

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored result of a stage, made only if no run before has."""
        base, state = self.folder.head()
        if name not in state["stages"]:
            df, path = make(), self.folder.new_path(name)
            df.write.parquet(path)
            entry = {"path": path.rsplit("/", 1)[1], "schema": df.schema.jsonValue()}
            self.folder.commit(base, {**state, "stages": {**state["stages"], name: entry}})
            state = self.folder.head()[1]
        entry = state["stages"][name]
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.folder.root}/{entry['path']}")


def run_feed_files(
    spark: SparkSession,
    feed: FeedSpec | str,
    config: Mapping[str, Any],
    configs: DataFrame,
    paths: FeedPaths,
    as_of: str,
    day: str | None = None,
    resume: int | None = None,
) -> DataFrame:
    """Load the file that is ready for ``config`` and return the log afterwards.

    The ready file is claimed in the stored log, read with the dialect of its config row,
    staged (replacing the last batch), merged into the stored dimension and synced into
    the stored mart. Raises ``MissingInput`` when no file is ready. A load that fails is
    logged and raises ``LoadFailed``; ``resume`` names a load that failed or was cut off,
    which goes on after its last finished stage. What a run made for itself is removed
    when it succeeds, what it only needed meanwhile in any case.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    log = Log(spark, paths.log)
    if resume is None:
        row = log.claim(configs, config["config_id"], as_of, day or as_of[:10], feed.ready_day_column)
    else:
        row = log.claim_again(resume, as_of)
    log_id = row["file_log_id"]
    try:
        run = Run(spark, f"{paths.runs.rstrip('/')}/{log_id}", as_of)
        with run_folder(spark, "load"):
            created = F.lit(run.as_of).cast("timestamp_ntz")
            raw = run.stage("raw", lambda: load_csv(spark, row["file_path"], config).withColumn("created_at", created))
            stg = run.stage("staged", lambda: stage_feed(raw, feed))
            reload(stg, paths.staging)
            dimension = Dimension(spark, paths.dimension)
            dimension.load(stg, read(spark, paths.calendar), run.as_of, f"log {log_id}")
            mart = Mart(spark, paths.mart, dimension)
            if not mart.folder.versions():
                mart.create(spark.createDataFrame([], MART_SCHEMA))
            mart.sync()
        done = log.move(log_id, "L_SE", as_of)
    except Exception as error:
        raise LoadFailed(str(error), log.move(log_id, "L_FE", as_of)) from error
    run.folder.remove()
    return done
