"""The readiness report: verdict rules, source priority, dedup, summaries."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import AS_OF, day
from shelflife.functions import fixed
from shelflife.operators import adhoc, readiness, reports
from shelflife.schemas import ACTIVITY, INVENTORY, POLICY, READINESS, empty

COLUMNS = "workspace_name string, item_name string, item_type string, item_id string, created_date date, last_modified_date date"


def items(spark, rows, days=10):
    frame = spark.createDataFrame([(*r[:4], day(r[4]), day(r[5])) for r in rows], COLUMNS)
    return frame.withColumn(
        "retention_period_days", F.when(F.col("item_type") != "NoRule", F.lit(days))
    )


def activity(spark, rows):
    return spark.createDataFrame(
        [(i, n, w, day(d)) for i, n, w, d in rows],
        "artifact_id string, artifact_name string, workspace_name string, last_modified_date date",
    )


def policy(spark, **days):
    return spark.createDataFrame(list(days.items()), "item_type string, retention_days int")


def report(spark, rows, seen=(), **days):
    found = readiness.assess(items(spark, rows), activity(spark, seen), policy(spark, **(days or {"T": 10})), AS_OF)
    return {r["item_name"]: r for r in found.collect()}


def test_verdicts_compare_calendar_days(spark):
    rows = report(
        spark,
        [
            ("w", "equal", "T", "1", None, "2026-03-10"),
            ("w", "over", "T", "2", None, "2026-03-09"),
            ("w", "future", "T", "3", None, "2026-03-25"),
            ("w", "undated", "T", "4", None, None),
            ("w", "unruled", "Other", "5", None, "2020-01-01"),
            ("w", "untyped", None, "6", None, "2020-01-01"),
        ],
    )
    verdict = {k: (r["days_since_modified"], r["exceeds_retention"], r["days_overdue"], r["status"]) for k, r in rows.items()}
    assert verdict == {
        "equal": (10, False, 0, fixed.STATUS_WITHIN),
        "over": (11, True, 1, fixed.STATUS_EXCEEDS),
        "future": (-5, False, 0, fixed.STATUS_WITHIN),
        "undated": (None, None, 0, fixed.STATUS_NO_DATE),
        "unruled": (2270, None, 0, fixed.STATUS_WITHIN),
        "untyped": (2270, None, 0, fixed.STATUS_WITHIN),
    }


def test_source_priority(spark):
    old, new = "2026-01-01", "2026-03-01"
    rows = report(
        spark,
        [
            (" W ", "by id", "T", "1", old, old),
            ("W", " By Name ", "T", "2", old, old),
            ("W", "both", "T", "3", old, old),
            ("W", "inventory", "T", "4", "2025-01-01", old),
            ("W", "created", "T", "5", old, None),
            ("W", "nothing", "T", "6", None, None),
            ("W", "\ttab", "T", "7", None, None),
            ("", "", "T", "8", None, None),
            (None, "no workspace", "T", "9", None, None),
        ],
        [
            ("1", "x", "y", new), ("1", "renamed", "y", "2026-02-01"), ("?", "by name", "w", new),
            ("3", "both", "w", "2026-02-02"), ("?", "both", "w", new), ("?", "tab", "w", new),
            ("?", "", "", new), ("?", "no workspace", None, new),
        ],
    )
    found = {k: (r["date_source"], str(r["last_modified_date"])) for k, r in rows.items()}
    assert found == {
        "by id": ("activity_id_match", new),
        " By Name ": ("activity_name_match", new),
        "both": ("activity_id_match", "2026-02-02"),
        "inventory": ("fabric_api", old),
        "created": ("created_date", old),
        "nothing": ("none", "None"),
        # Only spaces are trimmed; blank keys match, null keys do not.
        "\ttab": ("none", "None"),
        "": ("activity_name_match", new),
        "no workspace": ("none", "None"),
    }


def test_sub_items_take_the_date_of_their_parent(spark):
    rows = report(
        spark,
        [("w", "Lake/t", "LakehouseTable", "L", None, "2026-01-01"), ("w", "Lake", "Lakehouse", "L", None, None)],
        [("L", "Lake", "w", "2026-03-19")], LakehouseTable=10, Lakehouse=10,
    )
    assert {r["date_source"] for r in rows.values()} == {"activity_id_match"}
    assert len(rows) == 2


def test_system_objects_are_left_out_of_report_and_policy(spark):
    rows = [
        ("w", "L/Files", "LakehouseTable", "1", None, None),
        ("w", "L/TableMaintenance", "LakehouseTable", "1", None, None),
        ("w", "L/Files/x", "LakehouseTable", "1", None, None),
        ("w", "L/Files/Tables/x", "LakehouseFile", "1", None, None),
        ("w", "L/Files/a", "LakehouseFile", "1", None, None),
        ("w", "L/Files", "Report", "1", None, None),
        ("w", "L/Files", None, "1", None, None),
    ]
    assert sorted(report(spark, rows)) == ["L/Files", "L/Files/a", "L/Files/x"]
    kept = [tuple(r) for r in readiness.discover_types(items(spark, rows)).collect()]
    assert kept == [("LakehouseFile", 1, 10), ("LakehouseTable", 1, 10), ("Report", 1, 10)]


def test_policy(spark):
    rows = [("w", "a", "T", "1", None, None), ("w", "b", "T", "2", None, None), ("w", "c", "U", "3", None, None)]
    built = readiness.build_policy(items(spark, rows), AS_OF)
    assert built.columns == POLICY.fieldNames()
    assert sorted(tuple(r) for r in built.collect()) == [
        (k, 10, "flag_only", f"Retain {k} items for 10 day(s)", "2026-03-20") for k in ("T", "U")
    ]
    changed = readiness.override_policy(built, policy(spark, T=99, Z=1))
    assert {r["item_type"]: r["retention_days"] for r in changed.collect()} == {"T": 99, "U": 10}


dates = st.sampled_from([None, "2026-01-01", "2026-03-15"])
row = st.tuples(
    st.sampled_from(["w", "v"]), st.sampled_from(["a", "b"]), st.sampled_from(["T", "U", "V"]),
    st.sampled_from(["1", "2"]), dates, dates,
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=15), st.lists(st.tuples(st.sampled_from(["1", "9"]), st.just("a"), st.just("v"), dates), max_size=3))
def test_invariants(spark, rows, seen):
    found = readiness.assess(
        items(spark, rows), activity(spark, seen), policy(spark, T=10, U=100, V=1000), AS_OF
    ).collect()
    keys = [(r["item_id"], r["item_type"], r["item_name"]) for r in found]
    assert len(keys) == len(set(keys)) and set(keys) == {(r[3], r[2], r[1]) for r in rows}
    for r in found:
        assert (r["days_overdue"] > 0) == bool(r["exceeds_retention"])
        assert (r["last_modified_date"] is None) == (r["date_source"] == "none")
        assert (r["exceeds_retention"] is None) == (r["last_modified_date"] is None)


def test_headline_adds_up_and_sums_are_zero_filled(spark):
    rows = [("w", "a", "T", "1", None, None), ("w", "b", "T", "2", None, "2026-01-01"), ("v", "c", "T", "3", None, "2026-03-19")]
    found = readiness.assess(items(spark, rows), activity(spark, []), policy(spark, T=10), AS_OF)
    assert reports.readiness_headline(found).first().asDict() == {"total": 3, "overdue": 1, "within": 1, "no_date": 1}
    by_workspace = [tuple(r) for r in reports.readiness_by_workspace(found).collect()]
    assert by_workspace == [("w", 2, 1, 0, 1), ("v", 1, 0, 1, 0)]
    only_undated = found.where(F.col("last_modified_date").isNull())
    assert [tuple(r) for r in reports.readiness_by_type(only_undated).collect()] == [("T", 1, 0, 0, 1, None, None)]
    assert [r["item_name"] for r in adhoc.exceeding_items(found).collect()] == ["b"]
    assert [r["item_name"] for r in adhoc.within_items(found).collect()] == ["c"]
    assert [r["item_name"] for r in adhoc.unassessable_items(found).collect()] == ["a"]


def test_inventory_sums_stay_null_where_nothing_is_known(spark):
    frame = spark.createDataFrame(
        [("w", "T", None, None, None), ("v", "T", day("2026-01-01"), True, 5), ("v", "T", None, None, 8)],
        "workspace_name string, item_type string, last_modified_date date, is_overdue boolean, age_days int",
    )
    assert [tuple(r) for r in reports.inventory_by_workspace(frame).collect()] == [("v", 2, 1, 1), ("w", 1, 0, None)]
    # The average is cut, not rounded.
    assert reports.inventory_by_type(frame).first()["avg_age_days"] == 6
    assert adhoc.inventory_by_workspace(frame).collect()[1]["overdue"] == 0


def test_missing_activity_leaves_the_other_sources(spark):
    rows = items(spark, [("w", "a", "T", "1", "2026-01-01", None)])
    found = readiness.readiness(rows, empty(spark, ACTIVITY), policy(spark, T=10), AS_OF)
    assert found.columns == READINESS.fieldNames() and found.first()["date_source"] == "created_date"


@pytest.mark.parametrize("source", [INVENTORY])
def test_empty_inventory(spark, source):
    found = readiness.readiness(empty(spark, source), empty(spark, ACTIVITY), policy(spark, T=1), AS_OF)
    assert found.columns == READINESS.fieldNames() and found.count() == 0


def test_untyped_rows_with_a_system_name_go(spark):
    """NOT of an unknown is no yes: such a row is dropped, as an untyped row of another name is not."""
    names = ["a/Files", "a/Tables", "a/TableMaintenance", "a/Files/Tables/b", "a/Filesx", "plain"]
    rows = report(spark, [("w", name, None, str(n), None, None) for n, name in enumerate(names)])
    assert set(rows) == {"a/Filesx", "plain"}


def test_only_rows_with_a_dated_name_are_shuffled_for_it(spark):
    rows = items(spark, [("w" if i % 2 else None, f"n{i}", "T", f"i{i % 7}", None, None) for i in range(400)])
    seen = [("x", f"N{i}", "W", "2026-03-01") for i in range(40)] + [("x", "n1", None, "2026-03-02"), ("x", None, "w", None)]
    names = readiness.latest_by_name(activity(spark, seen))
    keyed = readiness.keyed(rows)
    plain = keyed.join(names, ["ws_key", "name_key"], "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = readiness.with_name_dates(keyed, names)
        assert "ws_key" not in found.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.select(*found.columns).collect()))
        assert found.where("act_date_by_name IS NOT NULL").count() == 20
        moved = readiness.with_name_dates(keyed, names).where("item_name = 'n300'")
        text = moved._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 1 and "Union" in text  # the other branch has no such join
        whole = readiness.assess(rows, activity(spark, seen), policy(spark, T=10), AS_OF)
        text = whole._jdf.queryExecution().executedPlan().toString()
        # Joined by id and deduplicated over two shuffles, so that a hot id can be split for the join.
        kinds = {line.split("hashpartitioning(")[1].count("#") for line in text.splitlines() if "hashpartitioning(item_id" in line}
        assert {2, 3} <= kinds
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
