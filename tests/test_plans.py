"""Plans: what reaches the scan, what is cut before the shuffle, and no Python."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, plan
from shelflife.operators import activity, adhoc, inventory, readiness, reports
from workload import inputs, queries

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "shelflife")


def physical(frame) -> str:
    return plan(frame).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = physical(queries.QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, (name, node)


def test_library_code_has_no_local_checkpoint_or_udf():
    for path in glob.glob(f"{LIBRARY}/**/*.py", recursive=True):
        with open(path, encoding="utf-8") as file:
            source = file.read()
        for word in ("localCheckpoint", "toPandas", "crossJoin", ".rdd", "pandas_udf", "F.udf"):
            assert word not in source, (path, word)


def test_dedup_is_cut_before_the_shuffle(spark):
    text = physical(inventory.dedupe_inventory(inputs.scored_entries(spark, SF_DIR)))
    assert re.search(r"Final.*Exchange.*Partial", text, re.DOTALL)
    report = physical(queries.readiness_report(spark, SF_DIR))
    assert report.count("WindowGroupLimit") == 2


def test_top_reports_do_not_sort_everything(spark):
    raw = inputs.raw_events(spark, SF_DIR)
    assert "TakeOrderedAndProject" in physical(reports.activity_distribution(raw, 15))
    report = readiness.assess(*queries._tables(spark, SF_DIR), AS_OF)
    assert "TakeOrderedAndProject" in physical(adhoc.exceeding_items(report, 100))


def test_policy_reads_three_columns(spark):
    text = physical(readiness.build_policy(inputs.inventory_table(spark, SF_DIR), AS_OF))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"item_name", "item_type", "retention_period_days"}


def test_days_prune_folders(spark):
    raw = inputs.raw_events(spark, SF_DIR)
    days = physical(activity.missing_days(raw, AS_OF))
    assert re.search(r"PartitionFilters: \[.*event_date", days)
    pages = inputs.event_pages(spark, SF_DIR)
    days = activity.days_to_collect(raw.where("event_date < '2024-01-25'"), inputs.AS_OF, 28)
    todo = pages.where(F.col("event_date").isin(days))
    assert re.search(r"PartitionFilters: \[.*event_date", physical(todo))
    assert [r[0].day for r in todo.select("event_date").distinct().orderBy("event_date").collect()] == list(range(25, 31))


def test_filters_reach_the_scan(spark):
    raw = inputs.raw_events(spark, SF_DIR)
    named = physical(adhoc.item_events(raw, "Customer#000000077"))
    assert "EqualTo(artifact_name,Customer#000000077)" in named
    overdue = physical(adhoc.overdue_items(inputs.inventory_table(spark, SF_DIR)))
    assert re.search(r"PushedFilters: \[[^\]]*is_overdue", overdue)
    kept = physical(raw.where(activity.text.modifies(F.col("activity"))).select("activity"))
    assert "Not(In(activity" in kept


def test_headline_is_one_pass(spark):
    report = readiness.assess(*queries._tables(spark, SF_DIR), AS_OF)
    text = physical(reports.readiness_headline(report))
    inventory_scans = [line for line in text.splitlines() if "FileScan" in line and "item_name" in line]
    assert len(inventory_scans) == 1
