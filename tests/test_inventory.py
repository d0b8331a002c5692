"""Dates per item, catalogued rows, derived workspace dates, dedup."""

import random

from helpers import AS_OF, day, moment, pages, with_seq
from shelflife.operators import inventory
from shelflife.schemas import INVENTORY, empty
from shelflife.sources import listings, scanner


def scan(spark, rows):
    return spark.createDataFrame(
        [(i, moment(c), moment(m), "pbi_scanner") for i, c, m in rows],
        "id string, created timestamp_ntz, modified timestamp_ntz, source string",
    )


def ranges(spark, rows):
    return spark.createDataFrame(
        [(i, moment(a), moment(b)) for i, a, b in rows],
        "artifact_id string, first_activity timestamp_ntz, last_activity timestamp_ntz",
    )


def test_scanner_reads_each_kind_and_the_last_entry_wins(spark):
    c, m, d = "2026-01-01T00:00:00Z", "2026-02-01T00:00:00Z", "2026-02-02T00:00:00Z"
    first = {
        "workspaces": [
            {
                "reports": [{"id": "r", "createdDateTime": c, "modifiedDateTime": m}, {"id": "", "createdDateTime": c}],
                "datasets": [{"id": "s", "createdDate": c, "modifiedDateTime": "", "modifiedDate": d}],
                "dataflows": [
                    {"objectId": "f", "id": "ignored", "configuredBy": "ann", "modifiedBy": "bob"},
                    {"id": "f2", "createdDateTime": c, "modifiedDateTime": m},
                ],
                "dashboards": [{"id": "b", "createdDateTime": c, "modifiedDateTime": m}],
            },
            {"datamarts": [{"id": "m", "createdDateTime": c, "modifiedDate": d}, {"id": "twice", "createdDateTime": c}]},
        ]
    }
    second = {"workspaces": [{"reports": [{"id": "twice", "modifiedDateTime": "nothing"}, {"id": "again", "createdDateTime": c}],
                              "dashboards": [{"id": "again", "modifiedDateTime": m}]}, {}]}
    found = scanner.scanner_dates(pages(spark, [first, second, "broken"]))
    c, m, d = (moment(t[:-1]) for t in (c, m, d))
    assert {r["id"]: (r["created"], r["modified"]) for r in found.collect()} == {
        "r": (c, m), "s": (c, d), "f": (None, None), "f2": (c, m), "b": (c, m), "m": (c, d),
        "twice": (None, None), "again": (None, m),
    }


def test_date_lookup(spark):
    a, b, c = "2026-01-01T00:00:00", "2026-02-01T00:00:00", "2026-03-01T00:00:00"
    found = inventory.build_date_lookup(
        scan(spark, [("older", a, b), ("newer", a, c), ("equal", a, b), ("empty", None, None), ("only", a, None)]),
        ranges(spark, [("older", a, c), ("newer", a, b), ("equal", a, b), ("empty", a, b), ("fresh", a, b)]),
    )
    rows = {r["id"]: (r["created"], r["modified"], r["source"]) for r in found.collect()}
    a, b, c = moment(a), moment(b), moment(c)
    assert rows == {
        "older": (a, c, "pbi_scanner"), "newer": (a, c, "pbi_scanner"), "equal": (a, b, "pbi_scanner"),
        "empty": (None, b, "pbi_scanner"), "only": (a, None, "pbi_scanner"), "fresh": (a, b, "activity_events"),
    }


def catalogued(spark):
    workspaces = listings.workspaces(
        pages(spark, [
            {"workspaces": [{"id": "W1", "name": "One", "type": "Workspace", "state": "Active"}, {"id": "w0", "state": "Deleted"}]},
            {"value": [{"id": "w2", "displayName": "Two"}, {"id": "w3"}]},
        ])
    )
    items = listings.items(
        pages(spark, [
            {"itemEntities": [
                {"id": "i1", "name": "Null hit", "type": "Report", "workspaceId": "W1"},
                {"id": "i2", "name": "By Name", "type": "Report", "workspaceId": "W1"},
                {"id": "i3", "name": " By Name", "type": "Report", "workspaceId": "W1", "description": "d"},
                {"id": "i4", "name": "Lost", "type": "Report", "workspaceId": "w0"},
                {"workspaceId": "w2"}]},
            {"value": [{"id": "i5", "displayName": "Dated", "type": "Lakehouse"}]},
        ], workspace_id=[None, "w2"])
    )
    lookup = scan(spark, [("i1", None, None), ("i5", "2026-03-01T06:00:00", "2026-03-10T06:00:00"), ("w3", None, None)])
    names = spark.createDataFrame(
        [("w1", "null hit", moment("2026-01-01T00:00:00"), moment("2026-01-02T00:00:00")),
         ("w1", "by name", moment("2026-01-01T00:00:00"), moment("2026-01-02T00:00:00"))],
        "ws_key string, name_key string, created timestamp_ntz, modified timestamp_ntz",
    )
    return inventory.catalog_items(inventory.catalog_entries(workspaces, items), lookup, names, AS_OF)


def test_catalogue(spark):
    rows = {(r["item_type"], r["item_name"]): r for r in catalogued(spark).collect()}
    assert set(rows) == {
        ("Workspace", "One"), ("Workspace", "Two"), ("Workspace", "Unknown"), ("Report", "Null hit"),
        ("Report", "By Name"), ("Report", " By Name"), ("Unknown", "Unknown"), ("Lakehouse", "Dated"),
    }
    # A hit by id wins although both its dates are null; the name is probed untrimmed.
    assert rows["Report", "Null hit"]["date_source"] == "pbi_scanner"
    assert rows["Report", "Null hit"]["last_modified_date"] is None
    assert rows["Report", "By Name"]["date_source"] == "activity_name_match"
    assert rows["Report", " By Name"]["date_source"] == "none"
    assert rows["Unknown", "Unknown"]["item_id"] == ""
    dated = rows["Lakehouse", "Dated"]
    assert (dated["workspace_name"], dated["workspace_type"], dated["age_days"], dated["is_overdue"]) == ("Two", "Unknown", 10, True)


def test_workspaces_are_dated_by_their_items_unless_the_scanner_knew_them(spark):
    rows = {
        r["item_name"]: r
        for r in inventory.derive_workspace_dates(catalogued(spark), AS_OF).collect()
        if r["item_type"] == "Workspace"
    }
    assert (rows["One"]["date_source"], rows["One"]["created_date"], rows["One"]["last_modified_date"]) == (
        "derived_from_items", day("2026-01-01"), day("2026-01-02"),
    )
    # Due on the day itself: compared by day, so not overdue at noon.
    two = rows["Two"]
    assert (two["deletion_due_date"], two["is_overdue"], two["age_days"]) == (day("2026-03-20"), False, 10)
    assert rows["Unknown"]["date_source"] == "pbi_scanner"
    assert rows["Unknown"]["last_modified_date"] is None


def keep_by_hand(rows):
    """First row of the best rank per key, rows in order."""
    best = {}
    for n, (key, created, modified) in enumerate(rows):
        rank = 0 if modified else 1 if created else 2
        if key not in best or rank < best[key][0]:
            best[key] = (rank, n)
    return {key: n for key, (_, n) in best.items()}


def test_dedup_equals_brute_force(spark):
    """Two thousand random rows over a few hundred keys, one of them null."""
    draw = random.Random(7)
    dates = [None, None, "2026-01-01", "2026-02-01"]
    keys = [None] + [str(k) for k in range(300)]
    rows = [(draw.choice(keys), draw.choice(dates), draw.choice(dates)) for _ in range(2000)]
    frame = spark.createDataFrame(
        [(n, k, "T", "name", day(c), day(m), str(n)) for n, (k, c, m) in enumerate(rows)],
        "n int, item_id string, item_type string, item_name string, created_date date, "
        "last_modified_date date, description string",
    )
    full = with_seq(frame)
    for field in INVENTORY.fields:
        if field.name not in full.columns:
            full = full.selectExpr("*", f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}")
    kept = inventory.dedupe_inventory(full).collect()
    assert {r["item_id"]: int(r["description"]) for r in kept} == keep_by_hand(rows)


def test_empty_inventory_keeps_its_schema(spark):
    nothing = with_seq(empty(spark, INVENTORY).selectExpr("*", "0 AS n"))
    assert inventory.dedupe_inventory(nothing).columns == INVENTORY.fieldNames()
    assert inventory.derive_workspace_dates(nothing, AS_OF).collect() == []
