"""The stored tables, and shared scratch space."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.schemas import conform, empty

TABLE_NAMES = {
    "inventory": "workspace_inventory",
    "raw": "activity_events_raw",
    "activity": "activity_last_modified",
    "policy": "retention_config",
    "readiness": "retention_readiness",
    "days": "activity_days",
    "landed_days": "activity_landed_days",
    "collections": "activity_collections",
    "extra": "activity_events_extra",
    "numbers": "activity_artifact_numbers",
    "bitmaps": "activity_day_bitmaps",
}

# Events lie by artifact inside a day, so a lookup skips pages by their bounds; Bloom filters
# tell which files hold an artifact or a name at all.  Row groups are small enough to skip.
DAY_ORDER = ["event_date", "artifact_id", "artifact_name"]
SKIPPING = {
    "parquet.bloom.filter.enabled#artifact_id": "true",
    "parquet.bloom.filter.enabled#artifact_name": "true",
    "parquet.bloom.filter.expected.ndv#artifact_id": "100000",
    "parquet.bloom.filter.expected.ndv#artifact_name": "100000",
    "parquet.block.size": str(32 * 1024 * 1024),
}


def clustered(rows: DataFrame) -> DataFrame:
    """Rows in the order in which a day is stored; small days together, large ones split."""
    balanced = rows.hint("rebalance", F.col("event_date"))
    return balanced.sortWithinPartitions(*[c for c in DAY_ORDER if c in rows.columns])


_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a local master gets a folder of its own, one per
    application; any other master is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="shelflife-")
    return _local[application]


_scratch: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared folder; what is left of it goes when the driver ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    _scratch.append((spark, folder))
    return folder


@atexit.register
def _remove_scratch() -> None:
    for spark, folder in _scratch:
        try:
            remove(spark, folder)
        except Exception:  # the session has ended, or the folder cannot be removed: try the next
            continue


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever it is kept; nothing happens where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that is removed at the end, also of a run that failed."""
    folder = scratch_folder(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)
        _scratch.remove((spark, folder))


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that runs inside go when it ends.

    Otherwise they lie on the executors' disks until the driver collects its garbage, so those
    of all steps of a long job add up.  A frame that is run again shuffles again.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def stage(rows: DataFrame, folder: str) -> DataFrame:
    """Write an intermediate result and read it back: computed once, lineage cut."""
    with freed_shuffles(rows.sparkSession):
        rows.write.mode("errorifexists").option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@dataclass
class Store:
    """Tables by short name: catalog tables, or folders below ``root`` when one is given.

    ``merge_schema`` makes folders show columns that only later appends brought; it
    reads every file's footer, so it is off unless asked for.
    """

    spark: SparkSession
    root: str | None = None
    fmt: str = "parquet"
    merge_schema: bool = False
    names: dict[str, str] = field(default_factory=lambda: dict(TABLE_NAMES))

    def _where(self, table: str) -> str:
        name = self.names[table]
        return name if self.root is None else f"{self.root.rstrip('/')}/{name}"

    def beside(self, name: str) -> str:
        """A folder next to the tables."""
        root = self.spark.conf.get("spark.sql.warehouse.dir") if self.root is None else self.root
        return f"{root.rstrip('/')}/{name}"

    def exists(self, table: str) -> bool:
        if self.root is None:
            return self.spark.catalog.tableExists(self._where(table))
        try:
            self.spark.read.format(self.fmt).load(self._where(table)).schema
        except AnalysisException:
            return False
        return True

    def load(self, table: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(self._where(table))
        reader = self.spark.read.format(self.fmt).option("mergeSchema", self.merge_schema)
        return reader.load(self._where(table))

    def load_or_empty(self, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows of the declared schema when it was never written."""
        return self.load(table) if self.exists(table) else empty(self.spark, schema)

    def overwrite(self, rows: DataFrame, table: str) -> None:
        """Replace the table and its schema.  ``rows`` must not read the same table."""
        writer = rows.write.format(self.fmt).mode("overwrite").option("overwriteSchema", True)
        if self.fmt == "parquet":
            writer = writer.option("compression", "zstd")
        if self.root is None:
            writer.saveAsTable(self._where(table))
        else:
            writer.save(self._where(table))

    def append(self, rows: DataFrame, table: str, few: bool = True) -> None:
        """Append rows, as one file if they are few."""
        writer = (rows.coalesce(1) if few else rows).write.format(self.fmt).mode("append")
        if self.root is None:
            writer.saveAsTable(self._where(table))
        else:
            writer.save(self._where(table))

    def append_days(self, rows: DataFrame, table: str) -> None:
        """Append, one folder per ``event_date``.

        The rebalance hint merges small and splits large days before they are written.
        """
        writer = (
            clustered(rows)
            .write.format(self.fmt)
            .mode("append")
            .options(**SKIPPING)
            .option("mergeSchema", True)
            .partitionBy("event_date")
        )
        if self.root is None:
            writer.saveAsTable(self._where(table))
        else:
            writer.save(self._where(table))

    def replace_days(self, rows: DataFrame, table: str) -> None:
        """Replace exactly the days that occur in ``rows``, which may read the same table.

        A table cannot be overwritten while it is read, so the rows are staged first.
        """
        columns = self.load(table).columns
        with scratch(self.spark) as folder:
            staged = stage(rows.select(columns), folder)
            if self.root is None:
                # A session of its own, so that no other job sees the changed setting.
                session = self.spark.newSession()
                session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
                staged = session.read.schema(staged.schema).parquet(folder)
                writer = clustered(staged).write.options(**SKIPPING)
                writer.insertInto(self._where(table), overwrite=True)
                self.spark.catalog.refreshTable(self._where(table))
            else:
                writer = clustered(staged).write.options(**SKIPPING)
                writer.format(self.fmt).mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy("event_date").save(self._where(table))

    def drop(self, table: str) -> None:
        """Forget a table."""
        if self.root is None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._where(table)}")
        else:
            remove(self.spark, self._where(table))

    def drop_days(self, table: str) -> None:
        """Forget a table kept by day, so that every day counts as not collected."""
        if self.root is None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._where(table)}")
        elif self.exists(table):
            # An empty partitioned write leaves a folder without files: no table.
            nothing = self.load(table).limit(0)
            nothing.write.format(self.fmt).mode("overwrite").partitionBy("event_date").save(
                self._where(table)
            )


# Every value is quoted; a null is written as the symbol for it, so it differs from "".
CSV = {
    "header": True, "quoteAll": True, "escape": '"', "nullValue": "\u2400", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n",
}

# A file with line breaks in its values is read by one task, so files are kept short.
EXPORT_ROWS = 200_000


def export_csv(readiness: DataFrame, folder: str) -> None:
    """The report as CSV with header, sorted by status and days overdue.

    Part files follow the sort order and hold ``EXPORT_ROWS`` rows at most; the whole report
    never passes through one task, neither here nor when it is read.
    Line breaks, quotes, outer spaces and empty texts survive.
    """
    ordered = readiness.orderBy(
        "status", "days_overdue", "item_type", "workspace_name", "item_name", "item_id"
    )
    writer = ordered.write.mode("overwrite").option("maxRecordsPerFile", EXPORT_ROWS)
    writer.options(**CSV).csv(folder)


def read_export(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.options(**CSV, multiLine=True).schema(schema).csv(folder)
    return conform(rows, schema)
