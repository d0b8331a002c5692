"""Exact distinct counts of artifacts that merge, kept beside the lines of finished days.

Every artifact id gets a number, counting from 0 in the order of first appearance, and every
day a bitmap over these numbers, in pieces of 32,768 bits.  The distinct artifacts of any
set of days are the bits set in the union of their bitmaps, so no report reads the events
again.  Only days whose line is new, or newer than their bitmap, are read, for two columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.operators.joins import spread_join
from shelflife.schemas import BITMAPS, EVENTS, NUMBERS, conform
from shelflife.sources.store import Store, scratch, stage
from shelflife.streaming.ingest import finished_days


def numbered(ids: DataFrame, first: int, folder: str) -> DataFrame:
    """Distinct ids with numbers from ``first`` on, without gaps and without a sort in one task.

    Each part counts its own rows; the parts' sums, one small row each, say where it begins.
    """
    row = F.monotonically_increasing_id()
    placed = ids.select("artifact_id", F.shiftright(row, 33).alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("n"))
    placed = stage(placed, f"{folder}/placed")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    begins = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    number = F.col("n") + F.col("begin") + F.lit(first)
    return conform(placed.join(F.broadcast(begins), "part").withColumn("number", number), NUMBERS)


def extend_bitmaps(store: Store) -> list[date]:
    """Number new artifacts and write the bitmaps of days that have none yet; returns the days."""
    lines = finished_days(store).select("event_date", "line")
    done = store.load_or_empty("bitmaps", BITMAPS).select("event_date", "line").distinct()
    due = lines.join(done, ["event_date", "line"], "left_anti")
    filled = finished_days(store).where("n_rows > 0").select("event_date")
    days = sorted(r["event_date"] for r in due.join(filled, "event_date", "left_semi").collect())
    if not days:
        return []
    with scratch(store.spark) as folder:
        raw = store.load_or_empty("raw", EVENTS).where(F.col("event_date").isin(days))
        seen = raw.where(F.col("artifact_id").isNotNull()).select("event_date", "artifact_id").distinct()
        seen = stage(seen, f"{folder}/seen")
        known = store.load_or_empty("numbers", NUMBERS)
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("n")).first()["n"]
        fresh = seen.select("artifact_id").distinct().join(known, "artifact_id", "left_anti")
        store.append(numbered(fresh, first, folder), "numbers", few=False)
        numbers = store.load("numbers")
        bits = (
            spread_join(seen, numbers, ["artifact_id"], "inner")
            .groupBy("event_date", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        )
        made = bits.join(F.broadcast(lines.where(F.col("event_date").isin(days))), "event_date")
        store.append(conform(made, BITMAPS), "bitmaps", few=False)
    return days


def _current(store: Store) -> DataFrame:
    """The bitmaps that belong to the newest line of their day."""
    lines = finished_days(store).select("event_date", "line")  # a row per day
    return store.load_or_empty("bitmaps", BITMAPS).join(F.broadcast(lines), ["event_date", "line"], "left_semi")


def distinct_artifacts(store: Store, first: date | None = None, last: date | None = None) -> DataFrame:
    """``unique_items`` over the days from ``first`` to ``last``, from the bitmaps alone."""
    days = F.col("event_date")
    rows = _current(store)
    if first is not None:
        rows = rows.where(days >= F.lit(first))
    if last is not None:
        rows = rows.where(days <= F.lit(last))
    pieces = rows.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_items"))


def coverage(store: Store) -> DataFrame:
    """The report of :func:`~shelflife.operators.reports.activity_coverage`, from lines and bitmaps."""
    days = finished_days(store).where("n_rows > 0").agg(
        F.min("event_date").alias("earliest"),
        F.max("event_date").alias("latest"),
        F.count("*").alias("days_covered"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_events"),
    )
    return days.select(
        "earliest", "latest", "days_covered", distinct_artifacts(store).scalar().alias("unique_items"), "total_events"
    )
