"""Report aggregates over the stored tables.

Each takes a table (or the assessed report) and returns the report's rows in its
order; ``limit`` is the number of rows a report shows, all rows when omitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed
from shelflife.functions.scoring import with_verdict


def top(rows: DataFrame, *order: Column | str, limit: int | None = None) -> DataFrame:
    """Sort, and keep the first rows when a limit is given."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def _ones(condition: Column) -> Column:
    """How many rows meet the condition; unknown counts as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))


def _dated() -> Column:
    return F.sum(F.col("last_modified_date").isNotNull().cast("int"))


def _whole_average(column: str) -> Column:
    return F.avg(column).cast("int")


def count_by_source(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("date_source").agg(F.count("*").alias("items"))
    return top(counts, F.desc("items"), "date_source")


# Readiness, from the stored report or the assessed one: verdicts are zero-filled.


def _verdicts() -> list[Column]:
    return [
        F.count("*").alias("total"),
        _ones(F.col("exceeds_retention")).alias("overdue"),
        _ones(~F.col("exceeds_retention")).alias("within"),
        _ones(F.col("last_modified_date").isNull()).alias("no_date"),
    ]


def readiness_headline(report: DataFrame) -> DataFrame:
    """All headline counts in one pass."""
    return with_verdict(report).agg(*_verdicts())


def readiness_by_type(report: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = with_verdict(report).groupBy("item_type").agg(
        *_verdicts(),
        F.max("days_since_modified").alias("max_days_inactive"),
        _whole_average("days_since_modified").alias("avg_days_inactive"),
    )
    return top(grouped, F.desc("overdue"), "item_type", limit=limit)


def readiness_by_workspace(report: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = with_verdict(report).groupBy("workspace_name").agg(*_verdicts())
    return top(grouped, F.desc("overdue"), "workspace_name", limit=limit)


# Inventory: sums over no known value stay null.


def inventory_headline(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.countDistinct("workspace_name").alias("workspaces"),
        F.count("*").alias("objects"),
        F.count("last_modified_date").alias("with_modified_date"),
        F.count_if(F.col("last_modified_date").isNull()).alias("without_modified_date"),
    )


def inventory_by_source(inventory: DataFrame) -> DataFrame:
    grouped = inventory.groupBy("date_source").agg(
        F.count("*").alias("items"), _dated().alias("has_date")
    )
    return top(grouped, F.desc("items"), "date_source")


def inventory_by_workspace(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = inventory.groupBy("workspace_name").agg(
        F.count("*").alias("total_objects"),
        _dated().alias("has_modified_date"),
        F.sum(F.col("is_overdue").cast("int")).alias("overdue_count"),
    )
    return top(grouped, "workspace_name", limit=limit)


def inventory_by_type(inventory: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = inventory.groupBy("item_type").agg(
        F.count("*").alias("total"),
        _dated().alias("has_modified_date"),
        F.sum(F.col("is_overdue").cast("int")).alias("overdue"),
        _whole_average("age_days").alias("avg_age_days"),
    )
    return top(grouped, F.desc("total"), "item_type", limit=limit)


def sub_item_counts(inventory: DataFrame) -> DataFrame:
    return (
        inventory.where(F.col("item_type").isin(fixed.SUB_ITEM_TYPES))
        .groupBy("item_type")
        .agg(
            F.count("*").alias("items"),
            F.count(F.coalesce("last_modified_date", "created_date")).alias("with_dates"),
        )
    )


# Activity.


def activity_coverage(raw: DataFrame) -> DataFrame:
    """Days and items are counted as groups, so that no event is repeated for it."""
    days = raw.groupBy("event_date").agg(F.count("*").alias("n"))
    by_day = days.agg(
        F.min("event_date").alias("earliest"),
        F.max("event_date").alias("latest"),
        F.count("event_date").alias("days_covered"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
    )
    items = raw.select("artifact_id").distinct().agg(F.count("artifact_id")).scalar()
    return by_day.select(
        "earliest", "latest", "days_covered", items.alias("unique_items"), "total_events"
    )


def activity_by_type(summary: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = summary.groupBy("artifact_type").agg(
        F.count("*").alias("items"),
        F.max("last_modified_date").alias("most_recent_modification"),
        _whole_average("modification_count").alias("avg_modifications"),
    )
    return top(grouped, F.desc("items"), "artifact_type", limit=limit)


def activity_by_workspace(summary: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = summary.groupBy("workspace_name").agg(
        F.count("*").alias("items"),
        F.max("last_modified_date").alias("most_recent_modification"),
    )
    return top(grouped, "workspace_name", limit=limit)


def activity_distribution(raw: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = raw.groupBy("activity").agg(
        F.count("*").alias("event_count"), F.countDistinct("artifact_id").alias("unique_items")
    )
    return top(grouped, F.desc("event_count"), "activity", limit=limit)


def daily_volume(raw: DataFrame, limit: int | None = None) -> DataFrame:
    grouped = raw.groupBy("event_date").agg(
        F.count("*").alias("events"), F.countDistinct("artifact_id").alias("unique_items")
    )
    return top(grouped, F.desc("event_date"), limit=limit)


def rows_per_collection(raw: DataFrame) -> DataFrame:
    grouped = raw.groupBy("collection_date").agg(F.count("*").alias("row_count"))
    return top(grouped, "collection_date")
