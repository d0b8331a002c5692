"""The ad-hoc queries over the stored tables.

Sorts that have few distinct keys (a date, a type) end in identifying columns:
results do not change between runs, and Spark can split a day that holds most of
the rows over several sort partitions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, times
from shelflife.functions.scoring import with_verdict
from shelflife.operators.reports import top

ITEM = ["workspace_name", "item_type", "item_name", "item_id"]
ARTIFACT = ["workspace_name", "artifact_type", "artifact_name"]


# Inventory.


def listing(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    return top(inventory, *ITEM, limit=limit)


def dated_items(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    rows = inventory.where(F.col("last_modified_date").isNotNull())
    ordered = top(rows, F.desc("last_modified_date"), *ITEM, limit=limit)
    return ordered.select(
        "workspace_name", "item_name", "item_type", "created_date", "last_modified_date",
        "date_source", "age_days", "retention_period_days", "deletion_due_date", "is_overdue",
    )


def overdue_items(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = top(inventory.where(F.col("is_overdue")), F.desc("age_days"), *ITEM, limit=limit)
    return ordered.select(
        "workspace_name", "item_name", "item_type", "age_days", "retention_period_days",
        "deletion_due_date", "date_source",
    )


def unknown_age(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = top(inventory.where(F.col("age_days").isNull()), *ITEM, limit=limit)
    return ordered.select("workspace_name", "item_name", "item_type", "date_source")


def undated_items(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    """Items that need attention because no source dated them."""
    return top(inventory.where(F.col("date_source") == fixed.SOURCE_NONE), *ITEM, limit=limit)


def inventory_by_workspace(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = inventory.groupBy("workspace_name").agg(
        F.count("*").alias("total_items"),
        F.count_if(F.col("is_overdue")).alias("overdue"),
        F.count_if(F.col("age_days").isNull()).alias("no_date"),
        F.round(F.avg("age_days"), 1).alias("avg_age_days"),
    )
    return top(grouped, "workspace_name", limit=limit)


def inventory_by_type(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = inventory.groupBy("item_type").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("is_overdue")).alias("overdue"),
        F.count_if(F.col("age_days").isNull()).alias("no_date"),
        F.min("age_days").alias("min_age"),
        F.max("age_days").alias("max_age"),
    )
    return top(grouped, F.desc("total"), "item_type", limit=limit)


# Activity.


def latest_collection(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of the newest collection run, newest event first."""
    newest = raw.agg(F.max("collection_date").alias("newest")).scalar()
    return collected_rows(raw.where(F.col("collection_date") == newest), limit)


def collected_rows(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """The same of rows that are known to be the newest collection's."""
    ordered = top(rows, F.desc("event_date"), F.desc("event_timestamp"), "artifact_id", limit=limit)
    return ordered.select(
        "event_date", "collection_date", "activity", "artifact_name", "workspace_name"
    )


def _summary_columns(summary: DataFrame) -> DataFrame:
    return summary.select(*ARTIFACT, "last_modified_date", "modification_count")


def newest_first(summary: DataFrame, limit: int | None = None) -> DataFrame:
    return _summary_columns(top(summary, F.desc("last_modified_date"), *ARTIFACT, limit=limit))


def modified_since(
    summary: DataFrame, as_of: datetime, days: int = 7, limit: int | None = None
) -> DataFrame:
    recent = summary.where(F.col("last_modified_date") >= F.date_sub(times.on(as_of), days))
    return newest_first(recent, limit)


def not_modified_since(
    summary: DataFrame, as_of: datetime, days: int = 14, limit: int | None = None
) -> DataFrame:
    stale = summary.where(F.col("last_modified_date") < F.date_sub(times.on(as_of), days))
    return _summary_columns(top(stale, "last_modified_date", *ARTIFACT, limit=limit))


def item_events(raw: DataFrame, artifact_name: str, limit: int | None = None) -> DataFrame:
    rows = raw.where(F.col("artifact_name") == artifact_name)
    return _events(rows, limit)


def artifact_events(raw: DataFrame, artifact_id: str, limit: int | None = None) -> DataFrame:
    """The same by artifact id, by which stored events lie."""
    return _events(raw.where(F.col("artifact_id") == artifact_id), limit)


def _events(rows: DataFrame, limit: int | None) -> DataFrame:
    ordered = top(rows, F.desc("event_timestamp"), "activity", "user_id", limit=limit)
    return ordered.select("event_date", "event_timestamp", "activity", "user_id")


# Readiness.


def most_overdue_first(readiness: DataFrame, limit: int | None = None) -> DataFrame:
    return top(readiness, F.desc("days_overdue"), *ITEM, limit=limit)


def status_contains(readiness: DataFrame, word: str = "EXCEEDS") -> DataFrame:
    return readiness.where(F.col("status").contains(word))


def exceeding_items(report: DataFrame, limit: int | None = None) -> DataFrame:
    rows = with_verdict(report).where(F.col("exceeds_retention"))
    ordered = top(rows, F.desc("days_overdue"), *ITEM, limit=limit)
    return ordered.select(
        "workspace_name", "item_name", "item_type", "last_modified_date", "date_source",
        "days_since_modified", "retention_days", "days_overdue",
    )


def within_items(report: DataFrame, limit: int | None = None) -> DataFrame:
    rows = with_verdict(report).where(~F.col("exceeds_retention"))
    ordered = top(rows, "item_type", "workspace_name", "item_name", "item_id", limit=limit)
    return ordered.select(
        "workspace_name", "item_name", "item_type", "last_modified_date", "date_source",
        "days_since_modified", "retention_days",
    )


def unassessable_items(report: DataFrame, limit: int | None = None) -> DataFrame:
    rows = report.where(F.col("last_modified_date").isNull())
    ordered = top(rows, "item_type", "workspace_name", "item_name", "item_id", limit=limit)
    return ordered.select("workspace_name", "item_name", "item_type")
