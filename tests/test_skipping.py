"""Lookups that skip data, and the newest collection by the days noted for it."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import event_pages, plan
from shelflife.operators import adhoc
from shelflife.schemas import EVENTS, conform
from shelflife.sources.store import Store
from shelflife.streaming.ingest import ingest_days, newest_collection

START = date(2026, 2, 1)


def events(spark, days=20, per_day=1500):
    """Every artifact has its events on one day; artifact 7 of that day has many."""
    n = F.col("id")
    return conform(
        spark.range(days * per_day).select(
            F.date_add(F.lit(START), (n % days).cast("int")).alias("event_date"),
            F.lit(datetime(2026, 2, 1, 12)).cast("timestamp_ntz").alias("event_timestamp"),
            F.lit("UpdateItem").alias("activity"),
            F.format_string("id-%05d", n % (days * 300)).alias("artifact_id"),
            F.format_string("Item %d", n % (days * 300)).alias("artifact_name"),
            F.lit("T").alias("artifact_type"), F.lit("w").alias("workspace_id"), F.lit("W").alias("workspace_name"),
            F.lit("u").alias("user_id"), F.lit(START).alias("collection_date"),
        ),
        EVENTS,
    )


def rows_read(frame) -> int:
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("replaced", [False, True])
def test_a_lookup_reads_less_than_a_tenth(spark, tmp_path, replaced):
    store = Store(spark, str(tmp_path))
    rows = events(spark)
    store.append_days(rows, "raw")
    if replaced:
        store.replace_days(store.load("raw"), "raw")
    raw = store.load("raw")
    total = raw.count()
    for lookup, found in (
        (raw.where("artifact_name = 'Item 4321'"), adhoc.item_events(raw, "Item 4321")),
        (raw.where("artifact_id = 'id-04321'"), adhoc.artifact_events(raw, "id-04321")),
    ):
        assert found.count() == 5 and lookup.count() == 5
        assert rows_read(lookup) < total / 10
    assert rows_read(raw.where("artifact_name = 'nothing has this name'")) == 0
    assert sorted(map(tuple, raw.select(*EVENTS.fieldNames()).collect())) == sorted(map(tuple, rows.collect()))


def test_days_lie_by_artifact(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append_days(events(spark, days=2), "raw")
    for file in store.load("raw").inputFiles():
        ids = [r[0] for r in spark.read.parquet(file).select("artifact_id").collect()]
        assert ids == sorted(ids)


def test_newest_collection_reads_its_days_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    names = spark.createDataFrame([("W1", "Sales")], "workspace_id string, workspace_name string")

    def pages(days):
        made = None
        for d in days:
            event = {"Activity": "UpdateItem", "CreationTime": f"2026-03-0{d}T10:00:00Z", "ArtifactId": "a", "WorkSpaceId": "W1"}
            page = event_pages(spark, [event], date(2026, 3, d))
            made = page if made is None else made.unionByName(page)
        return made

    assert newest_collection(store).count() == 0
    for day, landed in ((4, [1, 2, 3]), (8, [1, 2, 3, 5, 6])):
        ingest_days(pages(landed), names, store, datetime(2026, 3, day, 12))
    found = newest_collection(store)
    assert sorted(r.event_date.day for r in found.collect()) == [5, 6]
    assert {r.collection_date for r in found.collect()} == {date(2026, 3, 8)}
    assert "PartitionFilters: [event_date" in plan(found) or "event_date" in plan(found).split("PartitionFilters")[1][:80]
    whole = adhoc.latest_collection(conform(store.load("raw"), EVENTS)).collect()
    assert sorted(map(str, adhoc.collected_rows(found).collect())) == sorted(map(str, whole))
    store.drop("collections")  # a store from before
    assert sorted(r.event_date.day for r in newest_collection(store).collect()) == [5, 6]
    ingest_days(pages([5]), names, store, datetime(2026, 3, 9, 12), reset=True)
    assert [r.event_date.day for r in newest_collection(store).collect()] == [5]
