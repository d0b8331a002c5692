"""The inventory: dates per item, catalogued rows, derived workspace dates, dedup."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, scoring, times
from shelflife.operators.joins import lookup_join, spread_join
from shelflife.operators.keep import keep_first
from shelflife.schemas import INVENTORY, conform, no_entry

ENTRY_COLUMNS = [
    "workspace_name", "workspace_id", "workspace_type", "item_name", "item_id", "item_type",
    "description", "created_ts", "modified_ts", "date_source", "seq",
]


def row_seq(producer: int, parent: Column, entry: Column) -> Column:
    """Position of an inventory row: producer, then parent, then entry."""
    return F.struct(F.lit(producer).alias("producer"), parent.alias("parent"), entry.alias("entry"))


def build_date_lookup(scanner: DataFrame, ranges: DataFrame) -> DataFrame:
    """One row per id: scanner dates brought up to date by activity.

    Activity only moves ``modified`` forward; ids the scanner does not know take both
    dates from activity.  Both inputs hold one row per id.
    """
    known = scanner.withColumn("known", F.lit(True))
    active = ranges.select(F.col("artifact_id").alias("id"), "first_activity", "last_activity")
    by_scanner = F.col("known").isNotNull()
    return known.join(active, "id", "full_outer").select(
        "id",
        F.when(by_scanner, F.col("created")).otherwise(F.col("first_activity")).alias("created"),
        F.greatest("modified", "last_activity").alias("modified"),
        F.when(by_scanner, F.col("source")).otherwise(F.lit(fixed.SOURCE_ACTIVITY)).alias("source"),
    )


def catalog_entries(workspaces: DataFrame, items: DataFrame) -> DataFrame:
    """Every listed workspace and every item of a listed workspace, as undated entries."""
    own = workspaces.select(
        "workspace_name", "workspace_id", "workspace_type",
        F.col("workspace_name").alias("item_name"),
        F.col("workspace_id").alias("item_id"),
        F.lit(fixed.WORKSPACE).alias("item_type"),
        "description",
        row_seq(0, F.col("seq"), no_entry()).alias("seq"),
    )
    place = workspaces.select(
        "workspace_id", "workspace_name", "workspace_type", F.col("seq").alias("ws_seq")
    )
    inside = lookup_join(items, place, ["workspace_id"], "inner").select(
        "workspace_name", "workspace_id", "workspace_type", "item_name", "item_id", "item_type",
        "description", row_seq(1, F.col("ws_seq"), F.col("seq")).alias("seq"),
    )
    return own.unionByName(inside)


def attach_dates(entries: DataFrame, lookup: DataFrame, names: DataFrame) -> DataFrame:
    """Dates by id, else by (workspace, name).

    A hit by id wins even where both its dates are null, so the name is only tried
    for ids the lookup does not hold.
    """
    dates = lookup.select(
        F.col("id").alias("item_id"), F.col("created").alias("id_created"),
        F.col("modified").alias("id_modified"), F.col("source").alias("id_source"),
    )
    fallback = names.select(
        "ws_key", "name_key", F.col("created").alias("nm_created"),
        F.col("modified").alias("nm_modified"), F.lit(True).alias("nm_hit"),
    )
    keyed = entries.withColumns(
        {"ws_key": F.lower("workspace_id"), "name_key": F.lower("item_name")}
    )
    by_id = spread_join(keyed, dates, ["item_id"])
    by_name = spread_join(by_id, fallback, ["ws_key", "name_key"])
    hit = F.col("id_source").isNotNull()
    source = (
        F.when(hit, F.col("id_source"))
        .when(F.col("nm_hit"), F.lit(fixed.SOURCE_NAME_MATCH))
        .otherwise(F.lit(fixed.SOURCE_NONE))
    )
    return by_name.withColumns(
        {
            "created_ts": F.when(hit, F.col("id_created")).otherwise(F.col("nm_created")),
            "modified_ts": F.when(hit, F.col("id_modified")).otherwise(F.col("nm_modified")),
            "date_source": source,
        }
    ).select(*ENTRY_COLUMNS)


def scored(
    entries: DataFrame,
    as_of: datetime,
    policy: dict[str, int] | None = None,
    default_days: int = fixed.DEFAULT_RETENTION_DAYS,
) -> DataFrame:
    """Inventory columns of dated entries, plus their ``seq``."""
    rows = scoring.score(entries, as_of, policy, default_days)
    return rows.select(*INVENTORY.fieldNames(), "seq")


def catalog_items(
    entries: DataFrame,
    lookup: DataFrame,
    names: DataFrame,
    as_of: datetime,
    policy: dict[str, int] | None = None,
    default_days: int = fixed.DEFAULT_RETENTION_DAYS,
) -> DataFrame:
    """Scored inventory rows of the entries of :func:`catalog_entries`."""
    return scored(attach_dates(entries, lookup, names), as_of, policy, default_days)


def item_date_ranges(inventory: DataFrame) -> DataFrame:
    """Earliest creation and latest modification over each workspace's items."""
    return (
        inventory.where(F.col("item_type") != fixed.WORKSPACE)
        .groupBy("workspace_id")
        .agg(
            F.min("created_date").alias("earliest_created"),
            F.max("last_modified_date").alias("latest_modified"),
        )
    )


def derive_workspace_dates(inventory: DataFrame, as_of: datetime) -> DataFrame:
    """Date undated workspaces from their items, by calendar day.

    Run this before sub-items are added: tables and files do not date a workspace.
    """
    ranges = item_date_ranges(inventory)
    is_workspace = F.col("item_type") == fixed.WORKSPACE
    others = inventory.where(F.coalesce(~is_workspace, F.lit(True)))
    own = inventory.where(is_workspace).join(ranges, "workspace_id", "left")
    reference = F.coalesce("latest_modified", "earliest_created")
    derive = (F.col("date_source") == fixed.SOURCE_NONE) & reference.isNotNull()
    due = F.date_add(reference, F.col("retention_period_days"))
    age = times.whole_days_between(reference.cast("timestamp_ntz"), times.at(as_of))
    replacements = {
        "created_date": F.col("earliest_created"),
        "last_modified_date": F.col("latest_modified"),
        "date_source": F.lit(fixed.SOURCE_DERIVED),
        "age_days": age,
        "deletion_due_date": due,
        "is_overdue": times.on(as_of) > due,
    }
    derived = own.select(
        [
            F.when(derive, replacements[name]).otherwise(F.col(name)).alias(name)
            if name in replacements
            else F.col(name)
            for name in inventory.columns
        ]
    )
    return others.unionByName(derived)


def union_rows(*producers: DataFrame) -> DataFrame:
    """All inventory rows; ``seq`` keeps the producers in order."""
    return reduce(DataFrame.unionByName, producers)


def dedupe_inventory(rows: DataFrame) -> DataFrame:
    """One row per (item_id, item_type, item_name).

    The first row that has a modification date, else the first that has a creation
    date, else the first.
    """
    rank = (
        F.when(F.col("last_modified_date").isNotNull(), 0)
        .when(F.col("created_date").isNotNull(), 1)
        .otherwise(2)
    )
    kept = keep_first(rows, ["item_id", "item_type", "item_name"], [rank, F.col("seq")])
    return conform(kept, INVENTORY)
