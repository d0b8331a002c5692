"""The report by change against the whole report, day by day; what is joined; broken runs."""

import os
import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelflife.operators import changes, readiness
from shelflife.plans import by_change
from shelflife.schemas import READINESS
from shelflife.sources import versions
from shelflife.sources.store import stage

ITEMS = "workspace_name string, item_name string, item_type string, item_id string, created_date date, last_modified_date date"
SEEN = "artifact_id string, artifact_name string, workspace_name string, last_modified_date date"
RULES = "item_type string, retention_days int"
START = datetime(2026, 3, 1, 12)


def frames(spark, items, seen, rules):
    return (
        spark.createDataFrame(items, ITEMS).withColumn("retention_period_days", F.lit(10)),
        spark.createDataFrame(seen, SEEN),
        spark.createDataFrame(rules, RULES),
    )


def rows(report):
    return sorted(map(tuple, report.select(*READINESS.fieldNames()).collect()), key=str)


def kept_in(spark, tmp_path):
    return by_change.kept_state(spark, str(tmp_path))


def whole(kept):
    return [{p["name"]: p["whole"] for p in run["tables"]} for run in kept.runs()]


def some_day(rng):
    return rng.choice([None, START.date() - timedelta(days=rng.randrange(40))])


def some_item(rng, i):
    kind = rng.choice(["T", "U", None, "LakehouseTable", "LakehouseFile"])
    name = rng.choice([f"name {i}", f"Name {i} ", None, "a/Files", "a/Files/Tables/b", f"name {i // 2}"])
    return (rng.choice(["w", " W", None, "x"]), name, kind, rng.choice([None, f"i{i}", f"i{i // 3}"]), some_day(rng), some_day(rng))


@pytest.mark.parametrize("seed", [1])
def test_every_day_equals_the_whole_report(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(by_change, "ALL_SHARE", 10)  # by change, however much changed
    monkeypatch.setattr(versions, "WHOLE_SHARE", 3)
    rng = random.Random(seed)
    items = [some_item(rng, i) for i in range(60)]
    seen = [(f"i{rng.randrange(60)}", f"name {rng.randrange(60)}", rng.choice(["w", "x", None]), some_day(rng)) for _ in range(40)]
    rules = [("T", 5), ("U", 12), ("LakehouseTable", 2**31 - 2)]
    kept = kept_in(spark, tmp_path)
    for n in range(4):
        as_of = START + timedelta(days=[0, 3, 4, 30][n])
        given = frames(spark, items, seen, rules)
        assert rows(by_change.update(kept, *given, as_of)) == rows(readiness.readiness(*given, as_of))
        for _ in range(3):  # the tables of the next day
            items[rng.randrange(len(items))] = some_item(rng, rng.randrange(70))
            seen[rng.randrange(len(seen))] = (f"i{rng.randrange(70)}", f"name {rng.randrange(60)}", "w", some_day(rng))
        items += [items[0], some_item(rng, 99 + n)]
        items.pop(5)
        seen.pop(0)
        rules = rng.choice([rules, [("T", 5 + n), ("LakehouseFile", 3)], rules[:2]])
    assert [w["state"] for w in whole(kept)].count(False) >= 2


def test_only_reached_items_are_joined(spark, tmp_path, monkeypatch):
    old = date(2026, 2, 20)
    items = [("w", f"n{i}", "T", f"i{i}", None, old) for i in range(200)]
    seen, rules = [("i3", "n3", "w", old), ("?", "n7", "w", old)], [("T", 20), ("U", 9)]
    kept = kept_in(spark, tmp_path)
    by_change.update(kept, *frames(spark, items, seen, rules), START)
    joined = []
    assess = readiness.assess

    def noted(given, activity, policy, as_of):
        joined.append((given.count(), activity.distinct().count()))
        return assess(given, activity, policy, as_of)

    monkeypatch.setattr(readiness, "assess", noted)
    items[10] = ("w", "n10", "T", "i10", None, date(2026, 2, 27))  # changed
    items[11] = ("w", "renamed", "T", "i11", None, old)  # vanished and added
    items.append(("w", "new", "U", "i900", None, old))
    seen[1] = ("?", "n7", "w", date(2026, 2, 28))  # reaches n7 by name
    seen.append(("i20", "elsewhere", "w", old))  # reaches i20 by id, though its date stays
    as_of = START + timedelta(days=1)
    given = frames(spark, items, seen, rules)
    found = rows(by_change.update(kept, *given, as_of))
    assert joined == [(5, 2)] and whole(kept)[-1] == {"state": False, "dates_by_id": True, "dates_by_name": True, "retention": True}
    written = spark.read.parquet(f"{tmp_path}/state/version=2")
    assert written.where("NOT gone").count() == 5 and written.where("gone").count() == 1

    # The next day nothing changes: nothing is joined or written, yet the days are counted.
    found = rows(by_change.update(kept, *given, as_of + timedelta(days=1)))
    assert joined[1:] == [(0, 0)]
    assert {r[5] for r in found if r[1] == "n50"} == {11}

    # On the day their verdict turns, rows are judged from what they hold.
    as_of = datetime(2026, 3, 13, 12)
    found = rows(by_change.update(kept, *given, as_of))
    assert joined[2:] == [(0, 0)] and found == rows(assess_all(assess, given, as_of))
    assert sum("EXCEEDS" in r[7] for r in found) == 199


def assess_all(assess, given, as_of):
    report = assess(*given, as_of)
    return report.withColumn("report_date", F.lit(as_of.date()))


def test_a_broken_run_does_not_count(spark, tmp_path, monkeypatch):
    items = [("w", f"n{i}", "T", f"i{i}", None, date(2026, 2, 20)) for i in range(40)]
    given = frames(spark, items, [("i3", "n3", "w", date(2026, 2, 25))], [("T", 20)])
    kept = kept_in(spark, tmp_path)
    before = rows(by_change.update(kept, *given, START))
    changed = frames(spark, items[1:], [("i4", "n4", "w", date(2026, 2, 25))], [("T", 3)])
    with monkeypatch.context() as broken:
        broken.setattr(versions.Versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            by_change.update(kept, *changed, START)
    assert os.path.exists(f"{tmp_path}/state/version=2")
    assert rows(by_change.report(kept.load("state"), START)) == before
    found = rows(by_change.update(kept, *changed, START + timedelta(days=2)))
    assert found == rows(readiness.readiness(*changed, START + timedelta(days=2)))


def test_an_earlier_day_is_judged_as_a_whole_and_old_folders_go(spark, tmp_path):
    items = [("w", f"n{i}", "T", f"i{i}", None, date(2026, 2, 20)) for i in range(20)]
    given = frames(spark, items, [], [("T", 20)])
    kept = kept_in(spark, tmp_path)
    for days in (30, 0, 30, 31):
        as_of = START + timedelta(days=days)
        assert rows(by_change.update(kept, *given, as_of)) == rows(readiness.readiness(*given, as_of))
    assert whole(kept)[1]["state"] and not whole(kept)[3]["state"]
    assert by_change.last_day(kept) == date(2026, 4, 1)
    assert sorted(os.listdir(f"{tmp_path}/dates_by_id"))[0] != "version=1"


def test_empty_tables(spark, tmp_path):
    kept = kept_in(spark, tmp_path)
    empty = frames(spark, [], [], [])
    assert rows(by_change.update(kept, *empty, START)) == []
    assert rows(by_change.update(kept, *empty, START)) == []
    given = frames(spark, [("w", "n", "T", "i", None, None)], [], [])
    assert len(rows(by_change.update(kept, *given, START))) == 1
    assert rows(by_change.update(kept, *empty, START)) == []


def test_differences_and_digests(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 4), (None, 5)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("b", 1), ("c", None), ("e", None), (None, 5)], "k string, v int")
    found = changes.difference(old, new, ["k"], {"v": F.max}).collect()
    assert sorted((r.k, r.v, r.gone) for r in found) == [("b", 3, False), ("d", None, True), ("e", None, False)]
    frame = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a")], "x string, y string")
    parts = frame.select(*changes.digest("x", "y")).collect()
    assert len({(r.x, r.s) for r in parts}) == 4
    assert frame.select(changes.row_key("x", "y").alias("k")).distinct().count() == 4


def test_items_are_shuffled_once_to_be_judged(spark):
    items = [("w", f"n{i % 9}", "T", f"i{i % 4}", None, date(2026, 2, 20)) for i in range(40)]
    inventory, seen, rules = frames(spark, items, [("i3", "n3", "w", date(2026, 2, 25))], [("T", 20), ("T", 30)])
    keyed = by_change.keyed_items(inventory).select("*", *changes.digest(*by_change.READ))
    judged = by_change.judge(keyed, seen, rules, START)
    text = judged._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(item_id") == 1 and "hashpartitioning(row_key" not in text
    whole = keyed.groupBy("row_key").agg(*[put(c).alias(c) for c, put in changes.DIGEST.items()])
    parts = [*whole.columns]
    assert sorted(map(tuple, judged.select(parts).collect())) == sorted(map(tuple, whole.collect()))


def test_a_large_share_is_seen_before_all_digests_are_compared(spark, tmp_path, monkeypatch):
    items = [("w", f"n{i}", "T", f"i{i}", None, date(2026, 2, 20)) for i in range(30)]
    kept = kept_in(spark, tmp_path)
    by_change.update(kept, *frames(spark, items, [], [("T", 20)]), START)
    compared = []
    difference = by_change.difference

    def noted(old, new, keys, measures):
        compared.append(keys)
        return difference(old, new, keys, measures)

    monkeypatch.setattr(by_change, "difference", noted)
    given = frames(spark, items, [], [("T", 3)])  # reaches every item
    assert rows(by_change.update(kept, *given, START)) == rows(readiness.readiness(*given, START))
    assert compared and ["row_key"] not in compared


def test_a_whole_state_leaves_out_the_key_that_is_made(spark, tmp_path):
    items = [("w", f"n{i}", None if i % 2 else "T", f"i{i}" if i % 3 else None, None, None) for i in range(20)]
    kept = kept_in(spark, tmp_path)
    by_change.update(kept, *frames(spark, items, [], []), START)
    assert "row_key" not in spark.read.parquet(f"{tmp_path}/state/version=1").columns
    keys = by_change.keyed_items(frames(spark, items, [], [])[0]).select("row_key")
    assert sorted(kept.load("state").select("row_key").collect()) == sorted(keys.collect())


def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in held for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert stage(rows, str(tmp_path / "staged")).count() == 7
    until = time.time() + 20
    while time.time() < until and (left := {f for f in shuffle_files(spark) - before if f.endswith(".data")}) and len(left) > 1:
        time.sleep(0.2)
    assert len(left) <= 1  # that of the count above
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
