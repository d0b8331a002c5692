"""Activity events: normalise, collect incrementally, repair names, summarise."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelflife.functions import fixed, text, times
from shelflife.operators.joins import lookup_join
from shelflife.schemas import EVENTS, EXTRA, conform
from shelflife.sources.events import parsed_events, parsed_variants, unlisted_fields


def usable_events(
    pages: DataFrame, mail_dates: bool = False, seen: Observation | None = None
) -> DataFrame:
    """Parsed events with a time, an artifact id and a modifying activity.

    ``seen`` counts all events, also those left out, when the result is written.
    """
    events = parsed_events(pages, mail_dates)
    if seen is not None:
        events = events.observe(seen, *_counts()[:-1])
    return events.where(_usable())


def _usable():
    return (
        F.col("event_timestamp").isNotNull()
        & F.col("artifact_id").isNotNull()
        & text.modifies(F.col("activity"))
    )


def extra_fields(pages: DataFrame) -> DataFrame:
    """The fields of usable events that no spelling lists, ready to append to their table."""
    return conform(unlisted_fields(parsed_variants(pages).where(_usable())), EXTRA)


def normalize_events(
    pages: DataFrame,
    workspace_names: DataFrame,
    as_of: datetime,
    mask_personal: bool = True,
    seen: Observation | None = None,
    named: Observation | None = None,
) -> DataFrame:
    """Modification events ready to append to the raw table.

    The workspace name comes from the event, else from the lookup by workspace id,
    else it is the personal label.  ``event_date`` is the requested day.  ``seen`` and
    ``named`` count, when the result is written, what was parsed and where names came from.
    """
    events = resolve_names(usable_events(pages, seen=seen), workspace_names, mask_personal, named)
    return conform(events.withColumn("collection_date", times.on(as_of)), EVENTS)


def resolve_names(
    events: DataFrame,
    workspace_names: DataFrame,
    mask_personal: bool = True,
    named: Observation | None = None,
) -> DataFrame:
    """``workspace_name`` from the event, else the lookup, else the personal label."""
    own, found = text.blank_to_null(F.col("workspace_name")), text.blank_to_null(F.col("lookup_name"))
    fallback = F.lit(fixed.PERSONAL_LABEL) if mask_personal else _label_by_user()
    lookup = workspace_names.select("workspace_id", F.col("workspace_name").alias("lookup_name"))
    joined = lookup_join(events, lookup, ["workspace_id"])
    if named is not None:
        joined = joined.observe(
            named,
            F.count_if(own.isNotNull()).alias("named_by_event"),
            F.count_if(own.isNull() & found.isNotNull()).alias("named_by_lookup"),
            F.count_if(own.isNull() & found.isNull()).alias("named_by_label"),
        )
    return joined.withColumn("workspace_name", F.coalesce(own, found, fallback))


def _label_by_user():
    """Unmasked personal label of an event: the user where known, else the bare label."""
    return F.when(
        text.is_blank(F.col("user_id")), F.lit(fixed.PERSONAL_LABEL)
    ).otherwise(text.personal_label(F.col("user_id"), masked=False))


def _counts():
    """What the collector counts of parsed events.

    An event counts as raw once it has a time text and an id, before its time is parsed.
    A kept event always has a name, as the label is none.
    """
    timed = F.col("raw_time").isNotNull()
    identified = timed & F.col("artifact_id").isNotNull()
    read_only = text.is_read_only(F.col("activity"))
    kept = identified & ~read_only & F.col("event_timestamp").isNotNull()
    return [
        F.count_if(identified).alias("raw_events"),
        F.count_if(identified & read_only).alias("read_only_excluded"),
        F.count_if(kept).alias("kept"),
        F.count_if(identified & ~F.col("has_direct_id")).alias("recovered_by_fallback"),
        F.count_if(timed & F.col("artifact_id").isNull()).alias("dropped_without_id"),
        F.count_if(kept).alias("named"),
        F.lit(0).cast("bigint").alias("unnamed"),
    ]


def collection_counters(pages: DataFrame) -> DataFrame:
    """What the collector drops, keeps and can name, in one pass over landed pages.

    A run that collects gives the same numbers without a pass of their own, see
    :func:`~shelflife.streaming.ingest.ingest_days`.
    """
    *counts, unnamed = _counts()
    return parsed_events(pages).agg(*counts).withColumn("unnamed", unnamed)


def lookup_counters(pages: DataFrame) -> DataFrame:
    """The inventory's counters: an event counts only after its time parsed."""
    timed = F.col("raw_time").isNotNull()
    identified = timed & F.col("artifact_id").isNotNull()
    total = identified & F.col("event_timestamp").isNotNull()
    read_only = text.is_read_only(F.col("activity"))
    return parsed_events(pages, mail_dates=True).agg(
        F.count_if(total).alias("total_events"),
        F.count_if(total & read_only).alias("read_only_excluded"),
        F.count_if(total & ~read_only).alias("modification_events"),
        F.countDistinct(F.when(total & ~read_only, F.col("artifact_id"))).alias("unique_items"),
        F.count_if(identified & ~F.col("has_direct_id")).alias("recovered_by_fallback"),
        F.count_if(timed & F.col("artifact_id").isNull()).alias("dropped_without_id"),
    )


def missing_days(
    collected: DataFrame, as_of: datetime, lookback_days: int = 28, include_today: bool = False
) -> DataFrame:
    """Days of the lookback window that have no row yet, oldest first."""
    window = times.calendar(collected.sparkSession, as_of, lookback_days, include_today)
    return window.join(
        F.broadcast(_days_in_window(collected, as_of, lookback_days)), "event_date", "left_anti"
    ).orderBy("event_date")


def _days_in_window(collected: DataFrame, as_of: datetime, lookback_days: int) -> DataFrame:
    """Collected days of the window: one row per day, so at most ``lookback_days + 1``."""
    first, last = as_of.date() - timedelta(days=lookback_days), as_of.date()
    return (
        collected.where(F.col("event_date").between(F.lit(first), F.lit(last)))
        .select("event_date")
        .distinct()
    )


def days_to_collect(collected: DataFrame, as_of: datetime, lookback_days: int = 28) -> list[date]:
    """The missing days as values, at most ``lookback_days`` of them.

    As literals they let a scan skip the folders of all other days.
    """
    return [row["event_date"] for row in missing_days(collected, as_of, lookback_days).collect()]


def nameless():
    """Rows that can be given a name by workspace id."""
    return (F.col("workspace_id") != "") & text.is_blank(F.col("workspace_name"))


def backfill_names(raw: DataFrame, workspace_names: DataFrame, mask_personal: bool = True) -> DataFrame:
    """Fill blank workspace names: by workspace id, then with the personal label.

    The label pass runs only when some row with a workspace id is still blank, and
    then reaches every blank row, also those without a workspace id.
    """
    lookup = workspace_names.select("workspace_id", F.col("workspace_name").alias("lookup_name"))
    blank = text.is_blank(F.col("workspace_name"))
    # Only rows without a name meet the lookup.
    matched = lookup_join(raw.where(blank), lookup, ["workspace_id"])
    filled = matched.withColumn(
        "workspace_name", F.coalesce("lookup_name", "workspace_name")
    ).select(*raw.columns)
    unnamed = raw.where(nameless()).select("workspace_id").distinct()
    named = lookup.where(~text.is_blank(F.col("lookup_name"))).select("workspace_id")
    unresolved = unnamed.join(named, "workspace_id", "left_anti").limit(1)
    label_needed = unresolved.agg((F.count("*") > 0).alias("needed")).scalar()
    label, can_label = F.lit(fixed.PERSONAL_LABEL), blank
    if not mask_personal:
        label = text.personal_label(F.col("user_id"), masked=False)
        can_label = blank & ~text.is_blank(F.col("user_id"))
    labelled = filled.withColumn(
        "workspace_name",
        F.when(can_label & label_needed, label).otherwise(F.col("workspace_name")),
    )
    return raw.where(~blank).unionByName(labelled)


def backfill_accounting(before: DataFrame, after: DataFrame) -> DataFrame:
    """Blank rows before, blank rows after, and the rows fixed."""
    was = before.agg(F.count_if(nameless())).scalar()
    return after.agg(F.count_if(nameless()).alias("blank_after")).select(
        was.alias("blank_before"), "blank_after", (was - F.col("blank_after")).alias("fixed")
    )


SUMMARY_KEYS = ["artifact_id", "artifact_name", "artifact_type", "workspace_id", "workspace_name"]


def summarize_activity(raw: DataFrame) -> DataFrame:
    """First and last modification per artifact identity.

    A renamed item has one row per name; the readiness joins aggregate again.
    """
    return raw.groupBy(*SUMMARY_KEYS).agg(
        F.to_date(F.min("event_timestamp")).alias("first_modified_date"),
        F.to_date(F.max("event_timestamp")).alias("last_modified_date"),
        F.count("*").alias("modification_count"),
        F.max("event_date").alias("latest_event_date"),
    )


def merge_activity_summaries(old: DataFrame, new: DataFrame) -> DataFrame:
    """Combine two summaries of disjoint events; equals the summary of all the events.

    Valid while the names in the older events did not change in between.
    """
    return old.unionByName(new).groupBy(*SUMMARY_KEYS).agg(
        F.min("first_modified_date").alias("first_modified_date"),
        F.max("last_modified_date").alias("last_modified_date"),
        F.sum("modification_count").alias("modification_count"),
        F.max("latest_event_date").alias("latest_event_date"),
    )


def activity_range(events: DataFrame) -> DataFrame:
    """First and last activity per artifact, with the first filled name and workspace."""
    arrival = F.struct("event_date", "seq")

    def first_filled_in(column: str):
        filled = ~text.is_blank(F.col(column))
        return F.coalesce(
            F.min_by(F.when(filled, F.col(column)), F.when(filled, arrival)), F.lit("")
        )

    return events.groupBy("artifact_id").agg(
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
        first_filled_in("artifact_name").alias("name"),
        first_filled_in("workspace_id").alias("workspace_id"),
    )


def activity_name_range(ranges: DataFrame) -> DataFrame:
    """Range per (workspace id, artifact name), both compared without case and outer space."""
    workspace, name = text.strip(F.col("workspace_id")), text.strip(F.col("name"))
    return (
        ranges.where((workspace != "") & (name != ""))
        .groupBy(F.lower(workspace).alias("ws_key"), F.lower(name).alias("name_key"))
        .agg(F.min("first_activity").alias("created"), F.max("last_activity").alias("modified"))
    )
