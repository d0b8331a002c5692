"""Events as variants: the listed fields as before, the others kept."""

import json
from datetime import date

import pytest

from helpers import AS_OF, event_pages, pages
from shelflife.operators import activity
from shelflife.schemas import EXTRA, conform
from shelflife.sources import events
from shelflife.sources.store import Store
from shelflife.streaming.ingest import ingest_days
from workload import inputs

ODD = [
    {"Activity": "UpdateItem", "CreationTime": "2026-03-10T10:00:00Z", "ArtifactId": "x", "More": "text", "Deep": {"b": 1, "a": [1, None]}},
    {"activity": "", "Activity": None, "CreationTime": "", "creationTime": "2026-03-10T10:00:00Z", "itemId": 17, "more": 1.25},
    {"ObjectId": "https://x/0a1b2c3d-0000-4000-8000-000000000001", "WorkSpaceId": {"id": 1}, "More": None, "Flag": False},
    {"ArtifactName": ["a", "b"], "UserId": True, "wörter mit 'Zeichen'": "ü", "a.b[0]": 3},
    {}, {"More": 12345678901234567890123},
]


def same(pages):
    new = events.parsed_variants(pages, mail_dates=True).drop("extra").drop("seq")
    old = events.parsed_events(pages, mail_dates=True).drop("seq")
    assert new.schema.simpleString() == old.schema.simpleString()
    assert sorted(map(str, new.collect())) == sorted(map(str, old.collect()))


def test_listed_fields_are_read_as_before(spark):
    same(inputs.event_pages(spark, "/root/testdata/sf0.001"))
    same(inputs.wider_event_pages(spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("n", range(len(ODD)))
def test_odd_events(spark, n):
    same(event_pages(spark, [ODD[n]]))


def test_other_fields_are_kept(spark):
    rows = events.unlisted_fields(events.parsed_variants(event_pages(spark, ODD))).collect()
    found = sorted((r.seq.pos, r.key, r.value) for r in rows)
    assert found == [
        (0, "Deep", '{"a":[1,null],"b":1}'), (0, "More", "text"), (1, "more", "1.25"), (2, "Flag", "false"),
        (2, "More", None), (3, "a.b[0]", "3"), (3, "wörter mit 'Zeichen'", "ü"), (5, "More", "12345678901234567890123"),
    ]
    assert [r.artifact_id for r in rows if r.key == "Deep"] == ["x"]
    typed = events.with_fields(events.parsed_variants(event_pages(spark, ODD)), {"More": "string", "more": "double", "Flag": "boolean"})
    got = {r.seq.pos: tuple(r)[-3:] for r in typed.collect()}
    assert got[0] == ("text", None, None) and got[1] == (None, 1.25, None) and got[2] == (None, None, False)


def test_schema_and_bad_pages(spark):
    kind = events.discovered_schema(event_pages(spark, ODD))
    assert kind.startswith("OBJECT<") and "Deep: OBJECT<a: ARRAY<" in kind and "Activity: STRING" in kind
    bad = pages(spark, ["{not json", json.dumps({"other": 1}), json.dumps({"activityEventEntities": None})], event_date=[None] * 3)
    assert events.parsed_variants(bad).count() == 0


def test_other_fields_are_stored_with_the_days(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    names = spark.createDataFrame([("W1", "Sales")], "workspace_id string, workspace_name string")
    landed = event_pages(spark, ODD, date(2026, 3, 10))
    want = sorted(map(str, activity.extra_fields(landed).collect()))
    assert [r.key for r in activity.extra_fields(landed).orderBy("key").collect()] == ["Deep", "More", "more"]
    store.append_days(activity.extra_fields(landed).limit(1), "extra")  # of a broken run
    for reset in (False, False, True):
        ingest_days(landed, names, store, AS_OF, keep_extra=True, reset=reset)
        rows = conform(store.load("extra"), EXTRA).collect()
        assert sorted(map(str, rows)) == want
