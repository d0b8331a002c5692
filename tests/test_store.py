"""Stored tables, in the catalog and in folders; typed frames; export; the whole job."""

from datetime import date, datetime

import csv
import os

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, event_pages, pages
from shelflife.operators import activity
from shelflife.plans import daily
from shelflife.schemas import EVENTS, INVENTORY, POLICY, READINESS, empty, typed
from shelflife.sources.store import TABLE_NAMES, Store, export_csv, read_export, scratch, scratch_folder, stage
from shelflife.streaming.ingest import finish_days, finished_days


@pytest.fixture(params=["catalog", "folder"])
def store(request, spark, tmp_path):
    if request.param == "folder":
        return Store(spark, str(tmp_path))
    names = {k: f"t{abs(hash(request.node.name)) % 10**8}_{k}" for k in TABLE_NAMES}
    return Store(spark, names=names)


def events(spark, rows):
    return spark.createDataFrame(
        [(date(2026, 3, d), i, name, "w") for d, i, name in rows],
        "event_date date, artifact_id string, workspace_name string, workspace_id string",
    )


def test_missing_table_reads_as_empty(spark, store):
    assert not store.exists("raw")
    assert store.load_or_empty("raw", EVENTS).schema == EVENTS


def test_overwrite_replaces_rows_and_schema(spark, store):
    store.overwrite(spark.range(3), "inventory")
    store.overwrite(spark.range(2).withColumn("more", F.lit("x")), "inventory")
    assert store.load("inventory").columns == ["id", "more"]
    assert store.load("inventory").count() == 2


def test_days_are_appended_replaced_and_forgotten(spark, store):
    store.append_days(events(spark, [(1, "a", ""), (2, "b", "B")]), "raw")
    store.append_days(events(spark, [(3, "c", "")]), "raw")
    assert store.load("raw").count() == 3
    blank = store.load("raw").where("event_date <> '2026-03-02'")
    store.replace_days(blank.withColumn("workspace_name", F.lit("Filled")), "raw")
    rows = {r["artifact_id"]: (r["workspace_name"], r["event_date"]) for r in store.load("raw").collect()}
    assert rows == {"a": ("Filled", date(2026, 3, 1)), "b": ("B", date(2026, 3, 2)), "c": ("Filled", date(2026, 3, 3))}
    store.drop_days("raw")
    assert not store.exists("raw")
    store.append_days(events(spark, [(4, "d", "D")]), "raw")
    assert store.load("raw").count() == 1


def test_appended_days_may_bring_new_columns(spark, tmp_path):
    store = Store(spark, str(tmp_path), merge_schema=True)
    store.append_days(events(spark, [(1, "a", "")]), "raw")
    store.append_days(events(spark, [(2, "b", "")]).withColumn("extra", F.lit(1)), "raw")
    assert {r["artifact_id"]: r["extra"] for r in store.load("raw").collect()} == {"a": None, "b": 1}


def test_name_repair_touches_only_the_days_that_need_it(spark, store):
    names = spark.createDataFrame([("w", "Listed")], "workspace_id string, workspace_name string")
    store.append_days(events(spark, [(1, "a", ""), (1, "b", "B"), (2, "c", "C")]), "raw")
    finish_days(store, [date(2026, 3, 1), date(2026, 3, 2)])

    def files():
        second = store.load("raw").where("event_date = '2026-03-02'")
        return second.select(F.input_file_name()).distinct().collect()

    untouched = files()
    assert daily.repair_names(store, names) == [date(2026, 3, 1)]
    assert files() == untouched
    assert {r["event_date"].day: r["n_blank"] for r in finished_days(store).collect()} == {1: 0, 2: 0}
    assert sorted(r["workspace_name"] for r in store.load("raw").collect()) == ["B", "C", "Listed"]


def test_repair_writes_nothing_where_nothing_can_be_named(spark, tmp_path, monkeypatch):
    """Blank names without a workspace id stay blank, and no run rewrites their days."""
    store = Store(spark, str(tmp_path))
    names = spark.createDataFrame([("w", "Listed")], "workspace_id string, workspace_name string")
    rows = events(spark, [(1, "a", ""), (2, "b", "")])
    store.append_days(rows.withColumn("workspace_id", F.when(F.col("artifact_id") == "b", "w").otherwise("")), "raw")
    finish_days(store, [date(2026, 3, 1), date(2026, 3, 2)])
    assert daily.repair_names(store, names) == [date(2026, 3, 2)]
    monkeypatch.setattr(Store, "replace_days", lambda *args: pytest.fail("nothing is to be rewritten"))
    for _ in range(2):
        assert daily.repair_names(store, names) == []


def test_repair_without_users_is_tried_once_per_run_and_writes_nothing(spark, tmp_path, monkeypatch):
    """Unmasked labels need a user; a row without one stays blank."""
    store = Store(spark, str(tmp_path))
    names = spark.createDataFrame([("other", "X")], "workspace_id string, workspace_name string")
    store.append_days(events(spark, [(1, "a", "")]).withColumn("user_id", F.lit("")), "raw")
    finish_days(store, [date(2026, 3, 1)])
    monkeypatch.setattr(Store, "replace_days", lambda *args: pytest.fail("nothing is to be rewritten"))
    assert daily.repair_names(store, names, mask_personal=False) == []


def test_typed_frames_refuse_missing_keys(spark):
    row = {"item_type": "T", "retention_days": 1, "action": None, "description": None, "updated_date": None}
    assert typed(spark, [row], POLICY).schema == POLICY
    assert typed(spark, [], POLICY).schema == POLICY
    with pytest.raises(Exception):
        typed(spark, [{**row, "item_type": None}], POLICY).collect()


def test_export_is_sorted_over_its_files(spark, tmp_path):
    rows = spark.range(500).select(
        F.lit("w").alias("workspace_name"), F.col("id").cast("string").alias("item_name"),
        F.lit("T").alias("item_type"), F.lit(None).cast("date").alias("last_modified_date"),
        F.lit(1).alias("retention_days"), F.lit(1).alias("days_since_modified"),
        (F.col("id") % 7).cast("int").alias("days_overdue"),
        F.when(F.col("id") % 2 == 0, "🔴 a, b").otherwise("🟢").alias("status"),
        F.lit("none").alias("date_source"), F.lit(None).cast("date").alias("created_date"),
        F.lit(date(2026, 3, 20)).alias("report_date"), F.col("id").cast("string").alias("item_id"),
    )
    folder = str(tmp_path / "export")
    export_csv(rows, folder)
    back = read_export(spark, folder, READINESS)
    assert sorted(back.collect(), key=str) == sorted(rows.select(back.columns).collect(), key=str)
    files = sorted((tmp_path / "export").glob("part-*.csv"))
    lines = [line for f in files for line in csv.reader(f.open()) if line[0] != "workspace_name"]
    keys = [line[7] for line in lines]
    assert len(lines) == 500 and keys == sorted(keys)


def test_scratch_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_folder(spark)
    assert folder != scratch_folder(spark)
    assert shared is None or folder.startswith(shared)
    assert stage(spark.range(3), folder).count() == 3


def test_scratch_is_removed_also_after_a_failure(spark):
    with pytest.raises(ValueError), scratch(spark) as folder:
        stage(spark.range(3), folder)
        raise ValueError
    assert not os.path.exists(folder.removeprefix("file:"))


def test_a_run_leaves_nothing_in_the_shared_folder(spark, tmp_path, monkeypatch):
    shared = str(tmp_path / "shared")
    monkeypatch.setattr("shelflife.sources.store.shared_folder", lambda spark: shared)
    daily.run_daily(landed(spark), Store(spark, str(tmp_path / "tables")), AS_OF)
    broken = landed(spark)
    broken.lake_tables = spark.range(1)
    with pytest.raises(Exception):
        daily.run_daily(broken, Store(spark, str(tmp_path / "tables")), AS_OF)
    assert os.listdir(shared) == []


def test_export_keeps_odd_texts(spark, tmp_path):
    odd = ["two\nlines", "cr\r\nlf", ' padded ', "", None, 'say "x", y', "a,b", "\\", "\\n", '"', "null"]
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(odd)], "item_id string, item_name string")
    for field in READINESS.fields:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    folder = str(tmp_path / "export")
    export_csv(rows.select(READINESS.fieldNames()), folder)
    back = {int(r["item_id"]): r["item_name"] for r in read_export(spark, folder, READINESS).collect()}
    assert [back[i] for i in range(len(odd))] == odd and len(back) == len(odd)


def landed(spark):
    nothing = lambda: pages(spark, [], lakehouse_id=[])
    objects = "warehouse_id string, name string, type string, type_desc string, schema_id int, create_date timestamp_ntz, modify_date timestamp_ntz"
    return daily.Landed(
        workspaces=pages(spark, [{"value": [{"id": "w", "displayName": "W", "type": "Workspace"}]}]),
        items=pages(spark, [{"itemEntities": [{"id": "i", "name": "I", "type": "Report", "workspaceId": "w"}]}]),
        personal=pages(spark, []),
        scanner=pages(spark, [{"workspaces": [{"reports": [{"id": "i", "createdDateTime": "2026-01-01T00:00:00Z"}]}]}]),
        events=event_pages(spark, [{"CreationTime": "2026-03-10T08:00:00Z", "ArtifactId": "i", "WorkSpaceId": "w"}]),
        lake_tables=nothing(),
        paths=nothing(),
        warehouse_objects=spark.createDataFrame([], objects),
        warehouse_schemas=spark.createDataFrame([], "warehouse_id string, schema_id int, name string"),
    )


def test_daily_job_can_run_again(spark, store):
    for _ in range(2):
        rows = daily.run_daily(landed(spark), store, AS_OF).collect()
        found = {r["item_name"]: (r["date_source"], r["days_since_modified"], r["retention_days"]) for r in rows}
        assert found == {"I": ("activity_id_match", 10, 20), "W": ("fabric_api", 10, 10)}
    assert store.load("raw").count() == 1
    assert store.load("inventory").columns == INVENTORY.fieldNames()
    assert activity.missing_days(store.load("raw"), AS_OF).count() == 27


def test_summary_grows_by_the_new_days_and_recovers_from_a_lost_run(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS.fields)

    def add(*days):
        rows = [
            (date(2026, 3, d), datetime(2026, 3, d, 8), "Edit", "x", "X", "T", "w", "W", "u", date(2026, 3, 20))
            for d in days
        ]
        store.append_days(spark.createDataFrame(rows, schema), "raw")
        finish_days(store, [date(2026, 3, d) for d in days])
        return [date(2026, 3, d) for d in days]

    read = []
    whole = activity.summarize_activity

    def watched(raw):
        read.append(raw.count())
        return whole(raw)

    monkeypatch.setattr(daily.activity, "summarize_activity", watched)

    def check(new_days, repaired, rows_read):
        daily.update_summary(store, new_days, repaired)
        assert store.load("activity").collect() == whole(store.load("raw")).select(store.load("activity").columns).collect()
        assert read.pop() == rows_read

    check(add(1, 2), [], 2)
    check(add(3), [], 1)
    daily.update_summary(store, [], [])
    assert not read
    add(4)
    check(add(5), [], 5)
    check(add(6), [date(2026, 3, 1)], 6)


def test_failing_step_stops_the_job(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    broken = landed(spark)
    broken.workspaces = spark.range(1)
    with pytest.raises(Exception):
        daily.run_daily(broken, store, AS_OF)
    assert not store.exists("readiness")


def test_readiness_without_activity_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.overwrite(empty(spark, INVENTORY), "inventory")
    daily.update_readiness(store, AS_OF)
    assert store.load("readiness").count() == 0


def test_export_files_are_short(spark, tmp_path, monkeypatch):
    """A file is read by one task, as its values may hold line breaks."""
    monkeypatch.setattr("shelflife.sources.store.EXPORT_ROWS", 4)
    rows = spark.range(30).select(
        *[
            (F.concat(F.lit("a\nb"), F.col("id").cast("string")) if f.name == "item_name" else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in READINESS.fields
        ]
    )
    folder = str(tmp_path / "export")
    export_csv(rows.coalesce(1), folder)
    back = read_export(spark, folder, READINESS)
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30 and max(sizes) <= 4
    assert {r.item_name for r in back.collect()} == {f"a\nb{i}" for i in range(30)}
