"""The activity summary as a stateful stream over landed pages.

Each page counts once, however often it lands: its digest is kept in the state store for
as long as the watermark allows the same day to land.  First and last modification and the
count of every artifact identity are state as well, so a batch touches the identities it
has events of and no others; their new totals replace the old ones in the kept summary.
A batch is a version of the kept summary; one that is run again after a failure advances the
state, and is kept only if its line had not been written.

State grows with the distinct artifact identities, as the summary does, and with the pages
of the last ``delay``; on a cluster use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), which keeps it on disk.  The number of
state partitions is the number of shuffle partitions at the first run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.operators import activity
from shelflife.operators.changes import row_key
from shelflife.schemas import ACTIVITY, PAGE_SEQ, conform
from shelflife.sources.store import scratch, stage
from shelflife.sources.versions import Versions

#: Pages of a day land within so many days of the newest day seen.
DELAY = "28 days"
KEYS = {"summary": ["row_key"]}


@dataclass
class Run:
    """What one run of the stream did: batches, and rows that came too late to be counted."""

    batches: int
    too_late: int


def kept_summary(spark: SparkSession, folder: str) -> Versions:
    return Versions(spark, folder, KEYS)


def load_summary(kept: Versions) -> DataFrame:
    return conform(kept.load("summary"), ACTIVITY)


def _landed(spark: SparkSession, landing: str, files_per_batch: int | None) -> DataFrame:
    """New pages with their day; in a stream they need no order, so none is attached."""
    reader = spark.readStream.schema("value string, event_date date").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    none = F.struct(F.lit("").alias("file"), F.lit(0).alias("block"), F.lit(0).alias("line"))
    return reader.load(landing).select(
        none.cast(PAGE_SEQ).alias("page_seq"), F.col("value").alias("page"), "event_date"
    )


def summary_stream(
    pages: DataFrame,
    workspace_names: DataFrame,
    as_of: datetime,
    delay: str = DELAY,
    mask_personal: bool = True,
) -> DataFrame:
    """The totals of every artifact identity that a batch touches, from pages not seen before."""
    seen = pages.withColumns(
        {"landed_for": F.col("event_date").cast("timestamp"), "page_id": F.md5("page")}
    )
    once = seen.withWatermark("landed_for", delay).dropDuplicatesWithinWatermark(["event_date", "page_id"])
    events = activity.normalize_events(once.drop("landed_for", "page_id"), workspace_names, as_of, mask_personal)
    return activity.summarize_activity(events)


def run_summary_stream(
    spark: SparkSession,
    landing: str,
    workspace_names: DataFrame,
    kept: Versions,
    as_of: datetime,
    checkpoint: str,
    delay: str = DELAY,
    mask_personal: bool = True,
    files_per_batch: int | None = None,
) -> Run:
    """Take in what has landed since the last run, from where its checkpoint stands.

    ``workspace_names`` should be a stored table.  Rows of pages older than the watermark
    cannot be told from repeated ones; they are counted in ``too_late``, and a caller who
    finds some there summarises the stored events anew.
    """
    totals = summary_stream(_landed(spark, landing, files_per_batch), workspace_names, as_of, delay, mask_personal)

    def keep(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        keyed = batch.withColumns(
            {"row_key": row_key(*activity.SUMMARY_KEYS), "gone": F.lit(False)}
        )
        with scratch(spark) as folder:
            changes = stage(keyed, folder)  # the state advances with the rows that are read
            if version not in [run["version"] for run in kept.runs()]:
                kept.commit(version, as_of, {"summary": kept.put("summary", version, changes)})

    query = (
        totals.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    return Run(batches=len({p["batchId"] for p in progress}), too_late=late)
