"""The summary as a stream: pages landed again or late, restarts, a batch run twice."""

import json
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import AS_OF
from shelflife.operators import activity
from shelflife.schemas import ACTIVITY, EVENTS, conform
from shelflife.sources.pages import read_pages
from shelflife.sources.store import Store
from shelflife.streaming import ingest
from shelflife.streaming.summary import kept_summary, load_summary, run_summary_stream


def page(*events):
    entities = [
        {"Activity": "UpdateItem", "CreationTime": t, "ArtifactId": i, "ArtifactName": n, "WorkSpaceId": "W1"}
        for i, n, t in events
    ]
    return json.dumps({"activityEventEntities": entities})


def land(folder, day, name, *pages):
    place = folder / f"event_date={day}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text("\n".join(pages) + "\n")


@pytest.fixture
def names(spark):
    return spark.createDataFrame([("W1", "Sales")], "workspace_id string, workspace_name string")


@pytest.fixture
def run(spark, tmp_path, names):
    kept = kept_summary(spark, str(tmp_path / "kept"))

    def once(**options):
        return run_summary_stream(
            spark, str(tmp_path / "landing"), names, kept, AS_OF, str(tmp_path / "progress"), **options
        )

    return kept, once


def rows(frame):
    return sorted(map(str, conform(frame, ACTIVITY).collect()))


def whole(spark, landing, names):
    """The summary of every distinct page, in batch."""
    pages = read_pages(spark, str(landing)).dropDuplicates(["event_date", "page"])
    return activity.summarize_activity(activity.normalize_events(pages, names, AS_OF))


def test_pages_count_once_over_restarts(spark, tmp_path, names, run):
    landing, (kept, once) = tmp_path / "landing", run
    first = page(("a", "A", "2026-03-01T10:00:00Z"), ("b", "B", "2026-03-01T11:00:00Z"))
    land(landing, "2026-03-01", "1.json", first, page(("a", "A", "2026-03-01T12:00:00Z")))
    once()
    land(landing, "2026-03-01", "again.json", first)  # landed again
    land(landing, "2026-03-09", "1.json", page(("a", "A", "2026-03-09T08:00:00Z"), ("a", "New", "2026-03-09T09:00:00Z")))
    once()
    assert rows(load_summary(kept)) == rows(whole(spark, landing, names))
    land(landing, "2026-02-20", "late.json", page(("b", "B", "2026-02-20T01:00:00Z"), ("c", "C", "2026-02-20T01:00:00Z")))
    land(landing, "2026-03-10", "same.json", first)  # the same text for another day is another page
    done = once()
    assert done.too_late == 0 and rows(load_summary(kept)) == rows(whole(spark, landing, names))
    a = load_summary(kept).where("artifact_id = 'a' AND artifact_name = 'A'").first()
    assert (a.modification_count, a.first_modified_date, a.last_modified_date) == (4, date(2026, 3, 1), date(2026, 3, 9))
    before = [r["version"] for r in kept.runs()]
    once()  # nothing new
    assert rows(load_summary(kept)) == rows(whole(spark, landing, names))
    changed = [r["version"] for r in kept.runs() if r["version"] not in before]
    assert all(p["n_rows"] == 0 for r in kept.runs() if r["version"] in changed for p in r["tables"])


def test_only_touched_identities_are_written(spark, tmp_path, run):
    landing, (kept, once) = tmp_path / "landing", run
    land(landing, "2026-03-01", "1.json", *[page((f"i{n}", "N", "2026-03-01T10:00:00Z")) for n in range(60)])
    once()
    land(landing, "2026-03-02", "1.json", page(("i7", "N", "2026-03-02T10:00:00Z"), ("new", "N", "2026-03-02T10:00:00Z")))
    once()
    written = [p["n_rows"] for r in kept.runs() for p in r["tables"] if not p["whole"]]
    assert [n for n in written if n] == [2]
    assert load_summary(kept).count() == 61


def test_rows_behind_the_watermark_are_reported(tmp_path, run):
    landing, (kept, once) = tmp_path / "landing", run
    land(landing, "2026-03-10", "1.json", page(("a", "A", "2026-03-10T10:00:00Z")))
    once(delay="2 days")
    land(landing, "2026-03-01", "1.json", page(("b", "B", "2026-03-01T10:00:00Z")))
    land(landing, "2026-03-09", "1.json", page(("c", "C", "2026-03-09T10:00:00Z")))
    assert once(delay="2 days").too_late == 1
    assert {r[0] for r in load_summary(kept).select("artifact_id").collect()} == {"a", "c"}


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path, names, run):
    landing, (kept, once) = tmp_path / "landing", run
    land(landing, "2026-03-01", "1.json", page(("a", "A", "2026-03-01T10:00:00Z")))
    once()
    land(landing, "2026-03-02", "1.json", page(("a", "A", "2026-03-02T10:00:00Z")))
    commit, calls = type(kept).commit, []

    def broken(self, *args):
        commit(self, *args)
        calls.append(args)
        raise OSError("lost after the line was written")

    type(kept).commit = broken
    try:
        with pytest.raises(StreamingQueryException):
            once()
    finally:
        type(kept).commit = commit
    once()
    assert calls and rows(load_summary(kept)) == rows(whole(spark, landing, names))
    assert load_summary(kept).first().modification_count == 2


def test_days_without_events_are_read_once(spark, tmp_path, names, monkeypatch):
    landing, store = tmp_path / "landing", Store(spark, str(tmp_path / "tables"))
    for day in ("2026-03-01", "2026-03-02"):
        land(landing, day, "1.json", page(("a", "A", "not a time")))
    land(landing, "2026-03-03", "1.json", page(("a", "A", "2026-03-03T10:00:00Z")))
    monkeypatch.setattr(ingest.compact_lines, "__defaults__", (1,))

    def once():
        return ingest.ingest_stream(spark, str(landing), names, store, AS_OF, str(tmp_path / "progress"))

    assert len(once()) == 3
    assert once() == [] and once() == []
    land(landing, "2026-03-04", "1.json", page(("b", "B", "2026-03-04T10:00:00Z")))
    assert once() == [date(2026, 3, 4)]
    land(landing, "2026-03-05", "1.json", page(("b", "B", "2026-03-05T10:00:00Z")))
    assert once() == [date(2026, 3, 5)]
    lines = {r["event_date"].day: r["n_rows"] for r in ingest.finished_days(store).collect()}
    assert lines == {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}
    assert len(store.load("days").inputFiles()) == 1 and store.load("landed_days").count() == 0
    assert conform(store.load("raw"), EVENTS).count() == 3
    # In batch a day without events is tried again, as events may still land.
    land(landing, "2026-03-01", "2.json", page(("c", "C", "2026-03-01T10:00:00Z")))
    pages = read_pages(spark, str(landing)).withColumn("event_date", F.col("event_date").cast("date"))
    assert date(2026, 3, 1) in ingest.ingest_days(pages, names, store, AS_OF, 28)
    assert conform(store.load("raw"), EVENTS).count() == 4
