"""The readiness report: policy table, best date per item, one verdict per item."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, scoring, text, times
from shelflife.operators.changes import DIGEST
from shelflife.operators.joins import fits_broadcast, lookup_join, some_of, spread_join
from shelflife.operators.keep import keep_first
from shelflife.schemas import POLICY, READINESS, conform
from shelflife.sources.buckets import Bucketed

# Dates by id and by name are short rows, so more of them are broadcast than of other lookups.
DATES_ROWS = 1_000_000
DATES_BYTES = 96 * 1024 * 1024

GROUP = ["item_id", "item_type", "item_name"]
REPORT = [
    "workspace_name", "item_name", "item_type", "item_id", "last_modified_date", "date_source",
    "created_date", "retention_days", "days_since_modified", "exceeds_retention", "days_overdue",
    "status",
]


def without_system_objects(inventory: DataFrame) -> DataFrame:
    """Drop the folders and files every lakehouse keeps for itself."""
    kind, name = F.col("item_type"), F.col("item_name")
    folder = (kind == fixed.LAKEHOUSE_TABLE) & name.rlike(fixed.NOISE_TABLE_PATTERN)
    internal = (kind == fixed.LAKEHOUSE_FILE) & name.rlike(fixed.NOISE_FILE_PATTERN)
    return inventory.where(~folder).where(~internal)


def discover_types(inventory: DataFrame) -> DataFrame:
    """Item types with their counts and retention days, most frequent first."""
    return (
        without_system_objects(inventory)
        .groupBy("item_type")
        .agg(
            F.count("*").alias("item_count"),
            F.max("retention_period_days").alias("retention_days"),
        )
        .orderBy(F.desc("item_count"), "item_type")
    )


def build_policy(inventory: DataFrame, as_of: datetime) -> DataFrame:
    """One policy row per item type; untyped items get none."""
    types = (
        without_system_objects(inventory)
        .where(F.col("item_type").isNotNull())
        .groupBy("item_type")
        .agg(F.max("retention_period_days").alias("retention_days"))
    )
    return conform(
        types.withColumns(
            {
                "action": F.lit(fixed.POLICY_ACTION),
                "description": text.fill(
                    fixed.POLICY_TEXT, F.col("item_type"), F.col("retention_days").cast("string")
                ),
                "updated_date": F.date_format(times.on(as_of), "yyyy-MM-dd"),
            }
        ),
        POLICY,
    )


def override_policy(policy: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace the days of the types listed in ``overrides(item_type, retention_days)``."""
    changed = overrides.select("item_type", F.col("retention_days").alias("new_days"))
    days = F.coalesce("new_days", "retention_days")
    return (
        lookup_join(policy, changed, ["item_type"])
        .withColumn("retention_days", days)
        .select(*policy.columns)
    )


def latest_by_id(activity: DataFrame) -> DataFrame:
    return activity.groupBy(F.col("artifact_id").alias("item_id")).agg(
        F.max("last_modified_date").alias("act_date_by_id")
    )


def latest_by_name(activity: DataFrame) -> DataFrame:
    return activity.groupBy(
        text.name_key(F.col("workspace_name")).alias("ws_key"),
        text.name_key(F.col("artifact_name")).alias("name_key"),
    ).agg(F.max("last_modified_date").alias("act_date_by_name"))


def keyed(inventory: DataFrame) -> DataFrame:
    """The rows to judge, with the name keys they are dated by, and their digests if they have any."""
    return without_system_objects(inventory).select(
        "workspace_name", "item_name", "item_type", "item_id",
        F.col("last_modified_date").alias("inventory_modified_date"), "created_date",
        text.name_key(F.col("workspace_name")).alias("ws_key"),
        text.name_key(F.col("item_name")).alias("name_key"),
        *_digests(inventory),
    )


def _digests(rows: DataFrame) -> list[str]:
    """The parts of a digest (``operators/changes.py``), where the rows carry one."""
    return [*DIGEST] if set(DIGEST) <= set(rows.columns) else []


def assess(inventory: DataFrame, activity: DataFrame, policy: DataFrame, as_of: datetime) -> DataFrame:
    """Every item with its best date and verdict, one row per (id, type, name).

    Sub-items carry their parent's id, so the parent's activity dates them too.
    Besides the report's columns it keeps ``exceeds_retention``, which is null where
    a date or a retention period is missing, and the digest of the item's rows if they
    carry one.  Dates that are measured small are broadcast, so the rows are read once and
    shuffled for nothing but the dedup.
    """
    rows, names, dates = keyed(inventory), latest_by_name(activity), latest_by_id(activity)
    if _few(names):
        named = rows.join(F.broadcast(names), ["ws_key", "name_key"], "left")
    else:
        named = with_name_dates(rows, names)
    if _few(dates):
        dated = named.join(F.broadcast(dates), "item_id", "left")
    else:
        dated = with_id_dates(named, dates)
    return judged(dated, policy, as_of)


def _few(dates: DataFrame) -> bool:
    """Whether dates may be broadcast: measured, unless the session broadcasts nothing by itself."""
    limit = dates.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not limit.startswith("-") and fits_broadcast(dates, DATES_ROWS, DATES_BYTES)


def with_id_dates(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """The rows of :func:`keyed` with the date of their id, met in a shuffle."""
    # The length, which an id implies, keeps this shuffle from serving the report's dedup as well:
    # then the rows of a hot id could not be split.
    rows, dates = (t.withColumn("id_length", F.length("item_id")) for t in (rows, dates))
    return spread_join(rows, dates, ["item_id", "id_length"]).drop("id_length")


def with_name_dates(rows: DataFrame, names: DataFrame) -> DataFrame:
    """The rows of :func:`keyed` with the date of their name, and without the keys for it.

    Only rows whose name may be among the dated ones meet them; all others, as most sub-items
    are, are not shuffled by name.
    """
    keys = ["ws_key", "name_key"]
    names = names.where("ws_key IS NOT NULL AND name_key IS NOT NULL")
    columns = [*[c for c in rows.columns if c not in keys], "act_date_by_name"]
    marked = some_of(
        rows.withColumn("_name", F.xxhash64(*keys)), "_name", names.select(F.xxhash64(*keys).alias("_name"))
    )
    found = spread_join(marked.where("_maybe"), names, keys).select(*columns)
    others = marked.where("NOT _maybe").withColumn("act_date_by_name", F.lit(None).cast("date"))
    return found.unionByName(others.select(*columns))


def judged(dated: DataFrame, policy: DataFrame, as_of: datetime) -> DataFrame:
    """Verdicts of rows with their activity dates, one row per (id, type, name)."""
    days = policy.select("item_type", "retention_days")
    if _digests(dated):
        best = lookup_join(_best_with_digest(scoring.best_date(dated)), days, ["item_type"])
        return scoring.verdict_columns(best, as_of).select(*REPORT, *DIGEST)
    enriched = lookup_join(dated, days, ["item_type"])
    report = scoring.readiness_columns(enriched, as_of).select(*REPORT)
    # Dated rows first, the latest date first; the rest only breaks ties.
    order = [
        F.col("last_modified_date").desc_nulls_last(),
        F.col("workspace_name").asc_nulls_last(),
        F.col("created_date").asc_nulls_last(),
        F.col("date_source"),
    ]
    return keep_first(report, GROUP, order)


def _best_with_digest(dated: DataFrame) -> DataFrame:
    """The row that :func:`judged` keeps of every item, with the digest of all the item's rows.

    One aggregate in the order of :func:`judged`: rows are put together where they lie and
    shuffled once, and only then judged.
    """
    values = {
        "latest": -F.unix_date("last_modified_date"), "workspace": F.col("workspace_name"),
        "created": F.col("created_date"), "source": F.col("date_source"),
    }
    order = [part for name, c in values.items() for part in (c.isNull().alias(f"no_{name}"), c.alias(name))]
    found = dated.groupBy(*GROUP).agg(
        F.min(F.struct(*order)).alias("best"), *[put(c).alias(c) for c, put in DIGEST.items()]
    )
    return found.select(
        *GROUP, F.col("best.workspace").alias("workspace_name"), F.col("best.created").alias("created_date"),
        F.date_from_unix_date(-F.col("best.latest")).alias("last_modified_date"),
        F.col("best.source").alias("date_source"), *DIGEST,
    )


def dated_by_id(inventory: Bucketed, activity: Bucketed) -> tuple[DataFrame, DataFrame]:
    """Rows with the latest date of their id: those in buckets, and the others.

    Inventory rows in buckets meet the dates in buckets where both lie.  Ids with very many
    rows in either table are few; their dates, one a row, are joined as a lookup.
    """
    usual = latest_by_id(activity.lying)
    hot = latest_by_id(activity.loose.where(F.col("artifact_id").isNotNull()))
    hot = hot.withColumnRenamed("act_date_by_id", "hot_date")
    here = keyed(inventory.lying).join(usual, "item_id", "left")
    loose = spread_join(keyed(inventory.loose), usual, ["item_id"])
    found = []
    small = fits_broadcast(hot)
    for rows in (here, loose):
        rows = lookup_join(rows, hot, ["item_id"], small=small)
        latest = F.greatest("act_date_by_id", "hot_date")
        found.append(rows.withColumn("act_date_by_id", latest).drop("hot_date"))
    return found[0], found[1]


def readiness_in_buckets(
    inventory: Bucketed, activity: Bucketed, policy: DataFrame, as_of: datetime
) -> DataFrame:
    """The readiness table from tables that lie by item id.

    All rows of an item are in one part, so each part is deduplicated by itself.  Where the
    names are measured small and broadcast, the part in buckets is joined, judged and
    deduplicated without a shuffle; else the join by name is the only one.
    """
    names = latest_by_name(activity.rows)
    small = fits_broadcast(names)
    parts = [
        judged(lookup_join(part, names, ["ws_key", "name_key"], small=small), policy, as_of)
        for part in dated_by_id(inventory, activity)
    ]
    report = parts[0].unionByName(parts[1])
    return conform(report.withColumn("report_date", times.on(as_of)), READINESS)


def readiness(inventory: DataFrame, activity: DataFrame, policy: DataFrame, as_of: datetime) -> DataFrame:
    """The readiness table."""
    report = assess(inventory, activity, policy, as_of)
    return conform(report.withColumn("report_date", times.on(as_of)), READINESS)
