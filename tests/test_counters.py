"""Counters that fall off the write of a run."""

from datetime import date, datetime

from pyspark.sql import functions as F

from helpers import event_pages
from shelflife.operators import activity
from shelflife.schemas import EVENTS, conform
from shelflife.sources.pages import read_pages
from shelflife.sources.store import Store
from shelflife.streaming import ingest

AS_OF = datetime(2026, 3, 20, 12)


def landed(spark, day):
    time = {"CreationTime": f"2026-03-{day}T10:00:00Z", "Activity": "UpdateItem"}
    return event_pages(
        spark,
        [
            {**time, "ArtifactId": "x", "Activity": "ViewReport"}, {**time, "ItemId": "x", "WorkspaceName": "Own"},
            {"CreationTime": "garbage", "ItemId": "y"}, time, {"ArtifactId": "x"},
            {**time, "ArtifactId": "x", "WorkSpaceId": "W1"}, {**time, "ArtifactId": "x", "WorkSpaceId": "W2"},
        ],
        date(2026, 3, day),
    )


def names(spark):
    return spark.createDataFrame([("W1", "Sales"), ("W2", "")], "workspace_id string, workspace_name string")


def test_a_run_counts_what_it_writes(spark, tmp_path):
    store, counters = Store(spark, str(tmp_path)), {}
    pages = landed(spark, 10).unionByName(landed(spark, 11))
    ingest.ingest_days(pages, names(spark), store, AS_OF, counters=counters)
    want = activity.collection_counters(pages).first().asDict()
    assert {k: counters[k] for k in want} == want and want["kept"] == 6
    assert (counters["named_by_event"], counters["named_by_lookup"], counters["named_by_label"]) == (2, 2, 2)
    assert conform(store.load("raw"), EVENTS).count() == 6
    ingest.ingest_days(pages, names(spark), store, AS_OF, counters=counters, lookback_days=5)  # nothing to do
    assert set(counters.values()) == {0}


def test_pages_are_read_once_even_after_a_broken_run(spark, tmp_path):
    folder = tmp_path / "landing"
    for day in (10, 11):
        landed(spark, day).select(F.col("page").alias("value")).write.text(str(folder / f"event_date=2026-03-{day}"))
    store, counters, opened = Store(spark, str(tmp_path / "tables")), {}, spark.sparkContext.accumulator(0)
    noted = F.udf(lambda page: opened.add(1) or page, "string")
    pages = read_pages(spark, str(folder)).withColumn("page", noted.asNondeterministic()("page"))
    pages = pages.withColumn("event_date", F.col("event_date").cast("date"))
    half = activity.normalize_events(landed(spark, 10), names(spark), AS_OF).limit(1)
    store.append_days(half, "raw")
    ingest.ingest_days(pages, names(spark), store, AS_OF, counters=counters)
    assert opened.value == 2 and counters["kept"] == 6
    assert conform(store.load("raw"), EVENTS).count() == 6
