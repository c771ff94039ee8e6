"""New feed files as they arrive, instead of one look at the log per day."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.staging import stage_feed
from shelfmark.plans.warehouse import Dimension
from shelfmark.schemas import FeedSpec
from shelfmark.session import settle
from shelfmark.sources.csv_feed import load_csv

FILES_PER_BATCH = 1000


def load_new_files(
    spark: SparkSession,
    folder: str,
    config: Mapping[str, Any],
    checkpoint: str,
    load: Callable[[DataFrame, DataFrame, int], None],
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Hand every file of ``folder`` that was not loaded before to ``load``, once.

    ``load(rows, files, batch)`` gets the all-text rows of up to ``files_per_batch`` files, read
    in the dialect of ``config``, with the address of their file in ``_path``; and one row
    per file (``_path``, ``bytes``, ``rows``), also for a file without rows; and the number of the
    batch, by which ``load`` can tell a batch that comes again after a failure. The
    checkpoint remembers what has been loaded, so it takes the place of the ready state
    and the run guard of the log. Each start works off the new files, oldest first, and
    ends. What reaches the driver is the list of a batch's files, which has that bound.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    # contents are not read, as no column needs them
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("_path"), F.col("length").alias("bytes"))
    )

    def one_batch(batch: DataFrame, number: int) -> None:
        found = [tuple(row) for row in batch.collect()]
        if not found:
            return
        rows = load_csv(spark, [path for path, _, _ in found], config, numbered=False, file_column="_path")
        files = spark.createDataFrame([file[1:] for file in found], "_path string, bytes long")
        counts = rows.groupBy("_path").agg(F.count("*").alias("rows"))
        files = files.join(F.broadcast(counts), "_path", "left").na.fill(0, ["rows"])
        load(rows, files, number)

    return (
        arrived.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(one_batch).start()
    )


def load_into_dimension(
    spark: SparkSession,
    folder: str,
    config: Mapping[str, Any],
    checkpoint: str,
    feed: FeedSpec | str,
    dimension: Dimension,
    calendar: DataFrame,
    as_of: str,
    stream: str,
    loaded: Callable[[int], None] = lambda batch: None,
) -> StreamingQuery:
    """Stage every batch of new files and load it into the stored dimension, exactly once.

    The load is named by ``stream`` and the number of the batch, in the manifest that also
    makes it visible. A stream that is cut off between the load and its own checkpoint gets
    the same batch again, finds its name there and changes nothing. The files carry the
    staging ``id`` as a column. ``loaded`` is called after each batch.
    """

    def load(rows: DataFrame, files: DataFrame, batch: int) -> None:
        created = F.lit(as_of).cast("timestamp_ntz")
        raw = rows.drop("_path").withColumns({"id": F.col("id").cast("long"), "created_at": created})
        name = f"{stream} {batch}"
        if name not in dimension.state()["loads"]:
            # settled, as a load looks at its batch several times and each would parse the files
            dimension.load(settle(stage_feed(raw, feed), "staged"), calendar, as_of, name)
        loaded(batch)

    return load_new_files(spark, folder, config, checkpoint, load)
