"""Distinct artifacts from bitmaps, day by day."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from shelflife.operators import reports
from shelflife.schemas import EVENTS, NUMBERS, conform
from shelflife.sources.store import Store
from shelflife.streaming import coverage
from shelflife.streaming.ingest import finish_days


def events(spark, seen):
    rows = [(date(2026, 3, d), datetime(2026, 3, d, 12), i) for d, i in seen]
    frame = spark.createDataFrame(rows, "event_date date, event_timestamp timestamp_ntz, artifact_id string")
    return conform(
        frame.withColumns({c: F.lit("").cast(t) for c, t in EVENTS_REST.items()}).withColumn("collection_date", F.col("event_date")), EVENTS
    )


EVENTS_REST = {f.name: f.dataType for f in EVENTS.fields if f.name not in ("event_date", "event_timestamp", "artifact_id", "collection_date")}


def distinct(store, *days):
    return coverage.distinct_artifacts(store, *days).first()["unique_items"]


def test_bitmaps_count_as_the_events_do(spark, tmp_path):
    rng = random.Random(8)
    store, seen = Store(spark, str(tmp_path)), []
    for days in ([1, 2], [3], [5]):
        new = [(d, rng.choice([None, f"i{rng.randrange(60)}"])) for d in days for _ in range(40)]
        store.append_days(events(spark, new), "raw")
        finish_days(store, [date(2026, 3, d) for d in days])
        seen += new
        assert coverage.extend_bitmaps(store) == [date(2026, 3, d) for d in days]
        assert coverage.extend_bitmaps(store) == []
        want = reports.activity_coverage(conform(store.load("raw"), EVENTS)).first()
        assert coverage.coverage(store).first().asDict() == want.asDict()
    for lo, hi in ((1, 2), (2, 3), (4, 4), (3, 5)):
        ids = {i for d, i in seen if lo <= d <= hi and i}
        assert distinct(store, date(2026, 3, lo), date(2026, 3, hi)) == len(ids)
    numbers = sorted(r.number for r in store.load("numbers").collect())
    assert numbers == list(range(len({i for _, i in seen if i})))
    # A day that is written again gets a new line, and its old bitmap no longer counts.
    store.replace_days(events(spark, [(2, "only")]), "raw")
    finish_days(store, [date(2026, 3, 2)])
    assert coverage.extend_bitmaps(store) == [date(2026, 3, 2)]
    assert distinct(store, date(2026, 3, 2), date(2026, 3, 2)) == 1
    want = reports.activity_coverage(conform(store.load("raw"), EVENTS)).first()
    assert coverage.coverage(store).first().asDict() == want.asDict()


def test_more_artifacts_than_one_piece_holds(spark, tmp_path):
    ids = spark.range(70_000).select(F.concat(F.lit("a"), F.col("id")).alias("artifact_id")).repartition(6)
    found = coverage.numbered(ids, 5, str(tmp_path))
    assert found.schema.simpleString() == NUMBERS.simpleString()
    low, high, n, kinds = found.agg(F.min("number"), F.max("number"), F.count("*"), F.countDistinct("number")).first()
    assert (low, high, n, kinds) == (5, 70_004, 70_000, 70_000)
    store = Store(spark, str(tmp_path / "tables"))
    store.append(found, "numbers", few=False)
    day = F.date_add(F.lit(date(2026, 3, 1)), (F.col("id") % 2).cast("int"))
    rows = spark.range(70_000).select(F.concat(F.lit("a"), F.col("id")).alias("artifact_id"), day.alias("event_date"))
    store.append_days(conform(rows.withColumns({c: F.lit(None) for c in (*EVENTS_REST, "event_timestamp", "collection_date")}), EVENTS), "raw")
    finish_days(store, [date(2026, 3, 1), date(2026, 3, 2)])
    coverage.extend_bitmaps(store)
    assert distinct(store) == 70_000 and distinct(store, date(2026, 3, 2)) == 35_000
    assert store.load("bitmaps").select("bucket").distinct().count() == 3


def test_history_is_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert coverage.coverage(store).first().unique_items == 0 and coverage.extend_bitmaps(store) == []
    store.append_days(events(spark, [(1, "a"), (2, "b")]), "raw")
    finish_days(store, [date(2026, 3, 1), date(2026, 3, 2)])
    coverage.extend_bitmaps(store)
    found = coverage.coverage(store)
    assert "activity_events_raw" not in found._jdf.queryExecution().toString()
    assert found.first().unique_items == 2
