"""Tables that lie by key: parts, joins without a shuffle, and the same report."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, plan
from shelflife.operators import readiness
from shelflife.sources.buckets import write_buckets

ITEMS = "workspace_name string, item_name string, item_type string, item_id string, created_date date, last_modified_date date"
SEEN = "artifact_id string, artifact_name string, workspace_name string, last_modified_date date"


@pytest.fixture
def tables(spark, tmp_path):
    """Inventory and summary with null ids, and ids that are hot in one, the other or both."""
    rng = random.Random(2)

    def day():
        return rng.choice([None, date(2026, 3, rng.randrange(1, 19))])

    ids = [None, "hot", "seen-hot", "both", *[f"i{n}" for n in range(40)]]
    weights = [10, 40, 2, 40, *[2] * 40]
    items = [
        (rng.choice(["w", "x", None]), f"n{rng.randrange(30)}", rng.choice(["T", "U", None]), i, day(), day())
        for i in rng.choices(ids, weights, k=300)
    ]
    weights = [10, 2, 40, 40, *[2] * 40]
    seen = [(i, f"n{rng.randrange(30)}", rng.choice(["w", "x"]), day()) for i in rng.choices(ids, weights, k=200)]
    items, seen = spark.createDataFrame(items, ITEMS), spark.createDataFrame(seen, SEEN)
    made = [
        write_buckets(items, "buckets_items", "item_id", 4, str(tmp_path), hot_rows=30),
        write_buckets(seen, "buckets_seen", "artifact_id", 4, str(tmp_path), hot_rows=30),
    ]
    policy = spark.createDataFrame([("T", 5), ("U", 12)], "item_type string, retention_days int")
    yield items, seen, policy, *made
    for table in made:
        table.drop()


def physical(frame) -> str:
    return plan(frame).split("== Physical Plan ==")[1]


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_parts_hold_every_row_once(tables):
    items, seen, _, kept_items, kept_seen = tables
    assert rows(kept_items.rows) == rows(items) and rows(kept_seen.rows) == rows(seen)
    assert {r[0] for r in kept_items.loose.select("item_id").distinct().collect()} == {None, "hot", "both"}
    assert {r[0] for r in kept_seen.loose.select("artifact_id").distinct().collect()} == {None, "seen-hot", "both"}
    assert len(kept_items.lying.inputFiles()) <= 4


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_same_report(spark, tables, broadcast):
    items, seen, policy, kept_items, kept_seen = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        want = readiness.readiness(items, seen, policy, AS_OF)
        found = readiness.readiness_in_buckets(kept_items, kept_seen, policy, AS_OF)
        assert rows(found) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_is_shuffled_below_the_id_join(spark, tables):
    _, _, policy, kept_items, kept_seen = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lying, _ = readiness.dated_by_id(kept_items, kept_seen)
        text = physical(lying).split("BroadcastExchange")[0]  # behind it are the dates of hot ids
        assert "SortMergeJoin" in text and "hashpartitioning" not in text and "SelectedBucketsCount" in text
        # Judged and deduplicated where they lie, too, once the few names are broadcast.
        named = lying.join(F.broadcast(readiness.latest_by_name(kept_seen.rows)), ["ws_key", "name_key"], "left")
        judged = physical(readiness.judged(named, policy, AS_OF)).split("BroadcastExchange")[0]
        assert "Window" in judged and "hashpartitioning" not in judged
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
