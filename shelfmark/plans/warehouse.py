"""The stored log, dimension and mart; dimension and mart are loaded by increments.

*Log.* Every change of the log is a new version of its table, made from the newest one and
committed only if that is still the newest. So a file that is ready is claimed by one run:
of two runs that saw it ready, one commits, and the other looks again and finds it taken.

*Dimension.* Open versions (not deleted) and closed ones are kept apart. A load writes the
open versions anew, without those it expires, and the expired ones beside them as a further
closed part; no file of an earlier closed part is read for its values or written again. The
manifest then names the new open part, all closed parts, the highest id and the loads
applied. A load is named by its caller; one that is in the manifest already changes
nothing, so a load that is repeated after a failure, or a micro-batch that comes again, is
applied exactly once.

*Mart.* Rows are dealt into buckets by product name. A sync takes the changes of one load
from the dimension's parts (rows inserted, versions expired), reads the buckets these
names fall into and the open versions of these names, and writes these buckets anew. It
reads neither closed history nor other buckets. The result is that of a whole
``mart_sync`` after every load, given that the first one was whole.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import control, history
from shelfmark.operators.calendar import date_fk
from shelfmark.operators.checks import duplicate_keys
from shelfmark.operators.lookup import all_present, fits, lookup
from shelfmark.operators.mart import mart_sync
from shelfmark.operators.ranking import number_rows
from shelfmark.schemas import DIMENSION, DIMENSION_SCHEMA, KEYS, LOG_SCHEMA, MART, MART_SCHEMA, PRODUCT
from shelfmark.session import settle
from shelfmark.sources.versions import Conflict, Folder, Table

BUCKETS = 64
#: Bucket of rows without a name, whose presence decides about every insert.
NAMELESS = -1


class Log:
    """The load log in a versioned folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.table = spark, Table(spark, root, LOG_SCHEMA)

    def read(self) -> DataFrame:
        return self.table.read()

    def change(self, step: Callable[[DataFrame], DataFrame], attempts: int = 20) -> DataFrame:
        """Replace the log by ``step`` of it, on the newest state it meets."""
        for _ in range(attempts):
            base, _ = self.table.folder.head()
            try:
                return self.table.replace(step(self.read()), base)
            except Conflict:
                continue
        raise Conflict(f"the log changed {attempts} times meanwhile")

    def move(self, file_log_id: int, status: str, as_of: str) -> DataFrame:
        """Set a state that the row's own state leads to."""
        return self.change(lambda logs: control.transition(logs, file_log_id, status, as_of))

    def claim(self, configs: DataFrame, config_id: int, as_of: str, day: str | None = None, day_column: str = "create_time") -> Row:
        """Take the file of a configuration that is ready on a day; the row as it was.

        Raises ``MissingInput`` where none is ready (any more).
        """
        taken: list[Row] = []

        def loading(logs: DataFrame) -> DataFrame:
            ready = control.ready_file(logs, configs, config_id, day, day_column).first()
            if ready is None:
                raise control.MissingInput("File path is NULL or no file with C_SE status")
            taken.append(ready)
            return control.transition(logs, ready["file_log_id"], "L_P", as_of)

        self.change(loading)
        return taken[-1]

    def claim_again(self, file_log_id: int, as_of: str) -> Row:
        """Take up a file whose load failed or was cut off; the row as it was.

        The caller knows that no other run is at work on it.
        """
        row = control.by_id(self.read(), "file_log_id", file_log_id).first()
        if row is None or row["status"] not in ("L_P", "L_FE"):
            raise control.MissingInput(f"no unfinished load {file_log_id}")
        hit = F.col("file_log_id") == file_log_id
        now = F.lit(as_of).cast("timestamp_ntz")
        again = {"status": F.when(hit, F.lit("L_P")).otherwise(F.col("status")), "update_at": F.when(hit, now).otherwise(F.col("update_at"))}
        self.change(lambda logs: logs.withColumns(again))
        return row


class Dimension:
    """The product dimension in a versioned folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.folder = spark, Folder(spark, root)

    def state(self) -> dict[str, Any]:
        return self.folder.head()[1] or {"open": None, "closed": [], "top": 0, "loads": {}, "last": None}

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], DIMENSION_SCHEMA)
        return self.spark.read.schema(DIMENSION_SCHEMA).parquet(*[f"{self.folder.root}/{p}" for p in parts])

    def open(self, state: dict[str, Any] | None = None) -> DataFrame:
        """Versions that are not deleted; no closed part is scanned."""
        state = state or self.state()
        return self._rows([state["open"]] if state["open"] else [])

    def closed(self, state: dict[str, Any] | None = None) -> DataFrame:
        return self._rows((state or self.state())["closed"])

    def read(self) -> DataFrame:
        """All versions."""
        state = self.state()
        return self._rows([*([state["open"]] if state["open"] else []), *state["closed"]])

    def opened_by(self, load: str) -> DataFrame:
        """The open versions right after a load, which stay readable until it is released."""
        entry = self.state()["loads"][load]
        return self._rows([entry["open"]] if entry["open"] else [])

    def inserted(self, load: str) -> DataFrame:
        """Rows that a load put in."""
        return self.opened_by(load).where(F.col("id") > self.state()["loads"][load]["top"])

    def expired(self, load: str) -> DataFrame:
        """Versions that a load expired."""
        entry = self.state()["loads"][load]
        return self._rows([entry["closed"]] if entry["closed"] else [])

    def _write(self, rows: DataFrame) -> tuple[str | None, str | None]:
        """Stored parts of open and of other rows, in one job; None where there are none."""
        path = self.folder.new_path("load")
        part = F.when(F.col("isDelete") == F.lit(False), "open").otherwise("closed")
        rows.select(*DIMENSION).withColumn("_part", part).write.partitionBy("_part").parquet(path)
        name = path.rsplit("/", 1)[1]
        return tuple(f"{name}/_part={p}" if self.folder.exists(f"{path}/_part={p}") else None for p in ("open", "closed"))

    def create(self, rows: DataFrame, calendar: DataFrame) -> None:
        """Take over a whole dimension, with its date keys filled in, as the first version."""
        filled = settle(date_fk(rows.select(*DIMENSION), calendar), "dimension")
        opened, closed = self._write(filled)
        top = filled.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        self.folder.commit(0, {"open": opened, "closed": [closed] if closed else [], "top": top, "loads": {}, "last": None})

    def load(self, stg: DataFrame, calendar: DataFrame, as_of: str, load: str) -> bool:
        """Apply a batch as the load named ``load``; False if it has been applied before.

        What the batch does is what :func:`shelfmark.operators.history.scd2_load` does.
        """
        base, state = self.folder.head()
        state = state or self.state()
        if load in state["loads"]:
            return False
        as_of = str(as_of)
        repeated = duplicate_keys(stg.where(all_present(KEYS)), KEYS).first()
        if repeated is not None:
            raise ValueError(f"a batch has one row per key, this one repeats {tuple(repeated)}")
        small, opened = fits(stg), self.open(state)
        batch = settle(history.classify_parts(stg, opened, self.closed(state), small), "batch")
        changed = batch.filter(F.col("_action") == history.CHANGED).groupBy(*KEYS).agg(F.max("n").alias("n"))
        kept = history.expire_keys(opened, changed, as_of[:10], small or fits(changed))
        numbered = number_rows(batch.select("_action", "id", *PRODUCT, "source"), "id", state["top"], lead=["_action"])
        added = history.with_defaults(numbered.withColumn("id", F.col("_number")), as_of)
        added = added.select(*[F.col(f.name).cast(f.dataType) for f in DIMENSION_SCHEMA])
        new_open, expired = self._write(date_fk(kept.select(*DIMENSION).unionByName(added), calendar))
        entry = {"open": new_open, "closed": expired, "top": state["top"], "after": state["last"]}
        self.folder.commit(
            base,
            {
                "open": new_open,
                "closed": [*state["closed"], *([expired] if expired else [])],
                "top": state["top"] + batch.count(),
                "loads": {**state["loads"], load: entry},
                "last": load,
            },
        )
        return True

    def release(self, load: str) -> None:
        """Forget the parts of a load that has been passed on; its name stays."""

        def without(_: int, state: dict[str, Any]) -> dict[str, Any]:
            entry = {**state["loads"][load], "open": None, "closed": None}
            return {**state, "loads": {**state["loads"], load: entry}}

        self.folder.update(without)


def _bucket(buckets: int) -> Column:
    name = F.col("product_name")
    return F.when(name.isNull(), F.lit(NAMELESS)).otherwise(F.pmod(F.xxhash64(name), F.lit(buckets))).cast("int")


class Mart:
    """The mart of a stored dimension, in buckets of product names."""

    def __init__(self, spark: SparkSession, root: str, dimension: Dimension, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.dimension, self.buckets = spark, Folder(spark, root), dimension, buckets

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], MART_SCHEMA)
        return self.spark.read.schema(MART_SCHEMA).parquet(*[f"{self.folder.root}/{p}" for p in parts])

    def read(self) -> DataFrame:
        return self._rows(list(self.folder.head()[1].get("buckets", {}).values()))

    def _write(self, rows: DataFrame) -> dict[str, str]:
        path = self.folder.new_path("sync")
        rows.select(*MART).withColumn("_bucket", _bucket(self.buckets)).repartition("_bucket").write.partitionBy(
            "_bucket"
        ).parquet(path)
        name = path.rsplit("/", 1)[1]
        numbers = [NAMELESS, *range(self.buckets)]
        return {str(b): f"{name}/_bucket={b}" for b in numbers if self.folder.exists(f"{path}/_bucket={b}")}

    def _freed(self, before: DataFrame, after: DataFrame) -> str:
        """Names that left the mart in a sync; the next one may insert others of that name."""
        path = self.folder.new_path("freed")
        names = before.select("product_name").where("product_name IS NOT NULL").distinct()
        names.join(after.select("product_name").distinct(), "product_name", "left_anti").write.parquet(path)
        return path.rsplit("/", 1)[1]

    def create(self, rows: DataFrame) -> None:
        """The first version: ``rows`` after a whole sync with the dimension."""
        last = self.dimension.state()["last"]
        synced = settle(mart_sync(rows, self.dimension.read()), "mart")
        written = self._write(synced)
        self.folder.commit(0, {"buckets": written, "applied": last, "freed": self._freed(rows, synced), "count": self.buckets})

    def pending(self) -> list[str]:
        """Loads of the dimension that are not in the mart yet, in their order."""
        state, applied = self.dimension.state(), self.folder.head()[1].get("applied")
        waiting, load = [], state["last"]
        while load is not None and load != applied:
            waiting.append(load)
            load = state["loads"][load]["after"]
        return waiting[::-1]

    def sync(self) -> list[str]:
        """Bring the mart up to the dimension, load by load; returns the loads applied."""
        done = self.pending()
        for load in done:
            self._apply(load)
            self.dimension.release(load)
        return done

    def changes(self, load: str, state: dict[str, Any]) -> tuple[set[str], DataFrame, DataFrame]:
        """What a load concerns: the buckets, the open versions of its names, and the
        versions it expired."""
        freed = self.spark.read.schema("product_name string").parquet(f"{self.folder.root}/{state['freed']}")
        expired = self.dimension.expired(load)
        named = self.dimension.inserted(load).select("product_name").union(freed)
        names = settle(named.where("product_name IS NOT NULL").distinct(), "names")
        touched = names.union(expired.select("product_name")).select(_bucket(state["count"]).alias("b")).distinct()
        # at most as many rows as there are buckets
        buckets = {str(r["b"]) for r in touched.collect()} | {str(NAMELESS)}
        rows = lookup(self.dimension.opened_by(load), names, ["product_name"], "left_semi", "id", small=fits(names))
        return buckets & set(state["buckets"]), rows.select(*DIMENSION), expired

    def _apply(self, load: str) -> None:
        base, state = self.folder.head()
        buckets, rows, expired = self.changes(load, state)
        mart = self._rows([state["buckets"][b] for b in sorted(buckets)])
        synced = settle(mart_sync(mart, rows.unionByName(expired)), "mart")
        kept = {b: p for b, p in state["buckets"].items() if b not in buckets}
        changed = {"buckets": {**kept, **self._write(synced)}, "applied": load, "freed": self._freed(mart, synced)}
        self.folder.commit(base, {**state, **changed})
