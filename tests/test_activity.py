"""Events: extraction, filters, counters, days, name repair, summaries."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, event_pages, moment, pages, plan
from shelflife.functions import fixed
from shelflife.operators import activity
from shelflife.schemas import ACTIVITY, EVENTS, empty
from shelflife.sources import events, listings, pages as page_source
from shelflife.sources.pages import daily_pages as pages_by_day
from shelflife.sources.store import Store
from shelflife.streaming import ingest
from shelflife.streaming.ingest import ingest_days, ingest_stream

GUID_A, GUID_B = "0000000a-0000-4000-8000-00000000000a", "0000000b-0000-4000-8000-00000000000b"
TIME = {"CreationTime": "2026-03-10T08:00:00Z"}


def names_of(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()) or [("-", "-")], "workspace_id string, workspace_name string")


def ids(spark, found):
    rows = events.parsed_events(event_pages(spark, found)).orderBy("seq").collect()
    return [r["artifact_id"] for r in rows]


@pytest.mark.parametrize("key", fixed.DIRECT_ID_KEYS + fixed.OTHER_ID_KEYS)
def test_each_id_spelling_alone(spark, key):
    assert ids(spark, [{key: "x"}]) == ["x"]


def test_id_preference_and_fallbacks(spark):
    assert ids(
        spark,
        [
            {"ArtifactId": "", "artifactId": "lower"},
            {"ArtifactId": "Upper", "artifactId": "lower"},
            {"DataflowId": "d", "ItemId": "i", "ObjectId": GUID_A},
            {"ObjectId": f"https://x/groups/{GUID_A}/items/{GUID_B}"},
            {"ObjectId": "", "objectId": f"https://x/{GUID_A}"},
            {"ObjectId": "https://x/none"},
            {"ArtifactId": None},
            {},
        ],
    ) == ["lower", "Upper", "i", GUID_B, GUID_A, None, None, None]


def test_spellings_that_differ_by_case_stay_apart_in_files(spark, tmp_path):
    (tmp_path / "event_date=2026-03-10").mkdir()
    (tmp_path / "event_date=2026-03-10" / "p.json").write_text(
        '{"activityEventEntities":[{"ArtifactId":"a","artifactId":"b"},{"artifactId":"c"}]}\n'
        '{"activityEventEntities":[{"ArtifactId":"d"}]}\nnot json\n'
    )
    landed = page_source.read_pages(spark, str(tmp_path))
    rows = events.parsed_events(landed).orderBy("seq").collect()
    assert [(r["event_date"], r["artifact_id"]) for r in rows] == [
        (date(2026, 3, 10), x) for x in "acd"
    ]


def test_normalize_keeps_modifications_only_and_names_workspaces(spark):
    base = {**TIME, "ArtifactId": "x"}
    found = [
        {**base, "Activity": "EditReport", "WorkspaceName": "Own", "WorkSpaceId": "w1"},
        {**base, "Activity": "ViewReport"},
        {**base, "WorkSpaceId": "w1"},
        {**base, "workSpaceId": "w9", "UserId": "ann"},
        {**base, "CreationTime": ""},
        {**base, "CreationTime": "garbage"},
        {**TIME, "Activity": "EditReport"},
    ]
    frame = event_pages(spark, found)
    names = names_of(spark, w1="Listed", w2="")
    rows = activity.normalize_events(frame, names, AS_OF).collect()
    assert sorted(r["workspace_name"] for r in rows) == ["Listed", "My workspace", "Own"]
    assert {r["collection_date"] for r in rows} == {AS_OF.date()}
    assert {r["event_timestamp"] for r in rows} == {datetime(2026, 3, 10, 8)}
    shown = activity.normalize_events(frame, names, AS_OF, mask_personal=False).collect()
    assert sorted(r["workspace_name"] for r in shown) == ["Listed", "My workspace (ann)", "Own"]
    kept = activity.normalize_events(frame, names, AS_OF)
    assert kept.dtypes == empty(spark, EVENTS).dtypes


def test_the_two_counter_sets_differ_where_the_time_does_not_parse(spark):
    frame = event_pages(
        spark,
        [
            {**TIME, "ArtifactId": "x", "Activity": "ViewReport"},
            {**TIME, "ItemId": "x"},
            {"CreationTime": "garbage", "ItemId": "y"},
            {"CreationTime": "Tue, 17 Mar 2026 12:00:00 GMT", "ItemId": "z"},
            TIME,
            {"ArtifactId": "x"},
        ],
    )
    collector = activity.collection_counters(frame).first().asDict()
    assert collector == {
        "raw_events": 4, "read_only_excluded": 1, "kept": 1, "recovered_by_fallback": 3,
        "dropped_without_id": 1, "named": 1, "unnamed": 0,
    }
    lookup = activity.lookup_counters(frame).first().asDict()
    assert lookup == {
        "total_events": 3, "read_only_excluded": 1, "modification_events": 2, "unique_items": 2,
        "recovered_by_fallback": 3, "dropped_without_id": 1,
    }


@pytest.mark.parametrize(
    "collected, include_today, expected",
    [
        ([], False, 28),
        ([], True, 29),
        (range(1, 29), False, 0),
        ([5, 6, 0, 40], False, 26),
        ([0], True, 28),
    ],
)
def test_missing_days(spark, collected, include_today, expected):
    today = AS_OF.date()
    rows = [(today - timedelta(days=d),) for d in collected for _ in range(2)]
    frame = spark.createDataFrame(rows, "event_date date")
    found = [r[0] for r in activity.missing_days(frame, AS_OF, 28, include_today).collect()]
    assert len(found) == expected and found == sorted(found)
    assert (today in found) == (include_today and 0 not in collected)


def raw(spark, rows):
    frame = spark.createDataFrame(rows, "workspace_id string, workspace_name string, user_id string")
    return frame.withColumn("event_date", F.lit("2026-03-10").cast("date"))


def test_backfill_labels_every_blank_once_one_id_is_unresolved(spark):
    frame = raw(spark, [("w1", "", "a"), ("w9", None, "b"), ("", "", "c"), (None, None, ""), ("w1", "Kept", "d")])
    names = names_of(spark, w1="Listed")
    done = activity.backfill_names(frame, names)
    assert sorted(r["workspace_name"] for r in done.collect()) == [
        "Kept", "Listed", "My workspace", "My workspace", "My workspace",
    ]
    assert activity.backfill_accounting(frame, done).first().asDict() == {
        "blank_before": 2, "blank_after": 0, "fixed": 2,
    }
    again = activity.backfill_names(done, names)
    assert sorted(again.collect(), key=repr) == sorted(done.collect(), key=repr)
    shown = activity.backfill_names(frame, names, mask_personal=False)
    assert sorted(str(r["workspace_name"]) for r in shown.collect()) == [
        "Kept", "Listed", "My workspace (b)", "My workspace (c)", "None",
    ]


def test_backfill_leaves_blanks_alone_when_every_id_resolves(spark):
    frame = raw(spark, [("w1", "", "a"), ("", "", "c"), (None, None, "d")])
    done = activity.backfill_names(frame, names_of(spark, w1="Listed"))
    assert sorted(str(r["workspace_name"]) for r in done.collect()) == ["", "Listed", "None"]


def test_renamed_item_has_two_summary_rows_and_merge_equals_recompute(spark):
    rows = [
        (date(2026, 3, d), datetime(2026, 3, d, 9), "x", name, "Report", "w", "W")
        for d, name in [(1, "old"), (2, "old"), (3, "new"), (9, "new"), (10, None), (11, None)]
    ]
    frame = spark.createDataFrame(
        rows,
        "event_date date, event_timestamp timestamp_ntz, artifact_id string, artifact_name string, "
        "artifact_type string, workspace_id string, workspace_name string",
    )
    whole = activity.summarize_activity(frame)
    assert whole.count() == 3 and set(whole.columns) == set(ACTIVITY.fieldNames())
    split = F.col("event_date") < "2026-03-03"
    merged = activity.merge_activity_summaries(
        activity.summarize_activity(frame.where(split)),
        activity.summarize_activity(frame.where(~split)),
    )
    assert sorted(merged.collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_activity_range_takes_the_first_filled_name_in_arrival_order(spark):
    frame = event_pages(
        spark,
        [
            {"CreationTime": "2026-03-10T10:00:00Z", "ArtifactId": "x"},
            {"CreationTime": "2026-03-10T12:00:00Z", "ArtifactId": "x", "ArtifactName": " Second ", "WorkSpaceId": "W"},
            {"CreationTime": "2026-03-10T08:00:00Z", "ArtifactId": "x", "ArtifactName": "Third"},
            {"CreationTime": "2026-03-10T07:00:00Z", "ArtifactId": "y", "ArtifactName": "SECOND", "WorkSpaceId": "w"},
            {"CreationTime": "2026-03-10T07:00:00Z", "ArtifactId": "z", "ArtifactName": "  ", "WorkSpaceId": "w"},
        ],
    )
    ranges = activity.activity_range(activity.usable_events(frame, mail_dates=True))
    by_id = {r["artifact_id"]: r for r in ranges.collect()}
    assert by_id["x"]["name"] == " Second " and by_id["x"]["workspace_id"] == "W"
    assert by_id["x"]["first_activity"] == moment("2026-03-10T08:00:00")
    assert by_id["x"]["last_activity"] == moment("2026-03-10T12:00:00")
    named = activity.activity_name_range(ranges).collect()
    assert [tuple(r) for r in named] == [
        ("w", "second", moment("2026-03-10T07:00:00"), moment("2026-03-10T12:00:00"))
    ]


def daily_pages(spark, days):
    bodies = [
        {"activityEventEntities": [{"CreationTime": f"2026-03-{d:02d}T08:00:00Z", "ArtifactId": f"x{d}"}]}
        for d in days
    ]
    return pages(spark, bodies, event_date=[date(2026, 3, d) for d in days])


def collected(store):
    return sorted(r["artifact_id"] for r in store.load("raw").collect())


def test_ingest_appends_new_days_only(spark, tmp_path):
    store, names = Store(spark, str(tmp_path)), names_of(spark)
    ingest_days(daily_pages(spark, [5, 6]), names, store, AS_OF)
    ingest_days(daily_pages(spark, [5, 6, 6, 7, 20]), names, store, AS_OF)
    # Day 6 is collected, its late event is ignored; today is not over yet.
    assert collected(store) == ["x5", "x6", "x7"]
    ingest_days(daily_pages(spark, [5, 6, 7]), names, store, AS_OF)
    assert collected(store) == ["x5", "x6", "x7"]
    ingest_days(daily_pages(spark, [8, 9]), names, store, AS_OF, reset=True)
    assert collected(store) == ["x8", "x9"]


def test_streamed_ingest_reads_new_files_only(spark, tmp_path):
    store, names = Store(spark, str(tmp_path / "tables")), names_of(spark)
    landing = str(tmp_path / "landing")

    def land(days):
        lines = daily_pages(spark, days).select(F.col("page").alias("value"), "event_date")
        lines.write.mode("append").partitionBy("event_date").text(landing)
        return ingest_stream(spark, landing, names, store, AS_OF, str(tmp_path / "progress"))

    assert land([5, 6]) == [date(2026, 3, 5), date(2026, 3, 6)]
    assert land([6, 7]) == [date(2026, 3, 7)]
    # Day 6 is collected, its late event is ignored.
    assert collected(store) == ["x5", "x6", "x7"]


def test_streamed_ingest_loses_no_day_across_runs(spark, tmp_path):
    store, names = Store(spark, str(tmp_path / "tables")), names_of(spark)
    landing = str(tmp_path / "landing")

    def run(landed_days, today):
        lines = daily_pages(spark, landed_days).select(F.col("page").alias("value"), "event_date")
        lines.write.mode("append").partitionBy("event_date").text(landing)
        moment = datetime(2026, 3, today, 12)
        return [d.day for d in ingest_stream(spark, landing, names, store, moment, str(tmp_path / "progress"))]

    assert run([13, 15], 15) == [13]
    assert run([16, 15], 16) == [15]
    assert run([17], 18) == [16, 17]
    assert collected(store) == ["x13", "x15", "x15", "x16", "x17"]


def test_half_written_day_is_replaced(spark, tmp_path, monkeypatch):
    store, names = Store(spark, str(tmp_path)), names_of(spark)
    monkeypatch.setattr(ingest, "finish_days", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest_days(daily_pages(spark, [5, 6]), names, store, AS_OF)
    monkeypatch.undo()
    assert collected(store) == ["x5", "x6"]  # there, but not finished
    ingest_days(daily_pages(spark, [5, 5, 6, 7]), names, store, AS_OF)
    assert collected(store) == ["x5", "x5", "x6", "x7"]
    assert {r["event_date"].day: r["n_rows"] for r in ingest.finished_days(store).collect()} == {5: 2, 6: 1, 7: 1}


def test_ingest_reads_due_days_only(spark, tmp_path):
    store, names = Store(spark, str(tmp_path / "t")), names_of(spark)
    lines = daily_pages(spark, [5, 6, 7]).select(F.col("page").alias("value"), "event_date")
    lines.write.partitionBy("event_date").text(str(tmp_path / "landing"))
    landed, seen = pages_by_day(spark, str(tmp_path / "landing")), []

    def watched(days):
        seen.append([d.day for d in days])
        return landed([d for d in days if d.day < 7]) if len(seen) == 1 else landed(days)

    ingest_days(watched, names, store, AS_OF)
    ingest_days(watched, names, store, AS_OF)
    assert collected(store) == ["x5", "x6", "x7"]
    assert {5, 6, 7} <= set(seen[0]) and 7 in seen[1] and not {5, 6} & set(seen[1])
    todo = landed([date(2026, 3, 7)])
    assert re.search(r"PartitionFilters: \[.*event_date", plan(todo))


def test_workspace_names_prefer_the_organisation(spark):
    org = pages(spark, [{"workspaces": [{"id": "w1", "name": "First"}, {"id": "w1", "name": "Last"}]}])
    own = pages(
        spark,
        [{"value": [
            {"id": "w1", "type": "PersonalGroup", "users": []},
            {"id": "p1", "type": "PersonalGroup", "users": [
                {"groupUserAccessRight": "Member", "displayName": "Bob"},
                {"groupUserAccessRight": "Admin", "emailAddress": "", "displayName": "Ann"},
                {"groupUserAccessRight": "Admin", "emailAddress": "zed@example.org"}]},
            {"id": "p2", "type": "PersonalGroup", "users": [
                {"groupUserAccessRight": "Admin"},
                {"groupUserAccessRight": "Member", "emailAddress": "x@example.org"}]},
            {"id": "p3", "type": "PersonalGroup", "users": [{"groupUserAccessRight": "Member", "displayName": "Bob", "identifier": "b"}]},
            {"id": "p4", "type": "PersonalGroup"},
            {"id": "g1", "type": "Workspace"},
            {"id": "", "type": "PersonalGroup"}]}],
    )
    personal = listings.personal_workspaces(own, mask_personal=False)
    found = listings.workspace_names(listings.workspaces(org), personal).collect()
    assert {r["workspace_id"]: r["workspace_name"] for r in found} == {
        "w1": "Last", "p1": "My workspace (Ann)", "p2": "My workspace (unknown)",
        "p3": "My workspace (Bob)", "p4": "My workspace (unknown)",
    }


def test_empty_inputs_keep_their_schema(spark):
    nothing = event_pages(spark, [])
    assert activity.normalize_events(nothing, names_of(spark), AS_OF).collect() == []
    assert activity.summarize_activity(empty(spark, EVENTS)).collect() == []
    assert activity.collection_counters(nothing).first()["raw_events"] == 0
