"""Spark session with the settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; ``conf`` keys use ``__`` for dots.

    On a cluster the shuffle partition count is only the starting point that AQE
    coalesces from, so it is left to the cluster's own default.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # pages are large texts: keep a batch for the Python workers small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Spark copies the archive from the driver to the executors, like ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfmark-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


#: Private folder of each local application without a configured one.
_LOCAL: dict[str, str | None] = {}
#: Folder of the run that is going on, if any.
_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table a job writes and reads back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where
    none is named, and only in local mode, is a private one made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _LOCAL.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="shelfmark-")
        _LOCAL[spark.sparkContext.applicationId] = shared
    return f"{(_RUN.get() or shared).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """All that :func:`settle` writes in this block goes into one folder, deleted at its end.

    For work that ends inside the block: a frame read from there is gone with it.
    """
    path = scratch_path(spark, name)
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Used where one result feeds several branches, so an expensive step runs once and
    a lost executor re-reads files instead of repeating it. As a Parquet table it can
    be read by column, counted from its footers, and has a known size, by which the
    optimizer picks broadcasts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
