"""The table functions against the ad-hoc queries: the same rows in the same order."""

import pytest

from shelflife.operators import adhoc
from shelflife.plans import sql
from shelflife.sources.store import Store
from workload import inputs, queries
from workload.inputs import AS_OF

SF_DIR = "/root/testdata/sf0.001"
DAY = f"DATE '{AS_OF.date()}'"

PAIRS = {
    "retention_listing()": ("inventory", adhoc.listing, ()),
    "retention_dated()": ("inventory", adhoc.dated_items, ()),
    "retention_overdue()": ("inventory", adhoc.overdue_items, ()),
    "retention_unknown_age()": ("inventory", adhoc.unknown_age, ()),
    "retention_undated()": ("inventory", adhoc.undated_items, ()),
    "retention_by_workspace()": ("inventory", adhoc.inventory_by_workspace, ()),
    "retention_by_type()": ("inventory", adhoc.inventory_by_type, ()),
    "activity_latest_collection()": ("raw", adhoc.latest_collection, ()),
    "activity_newest()": ("activity", adhoc.newest_first, ()),
    f"activity_modified_since({DAY}, 20)": ("activity", adhoc.modified_since, (AS_OF, 20)),
    f"activity_modified_since({DAY})": ("activity", adhoc.modified_since, (AS_OF,)),
    f"activity_not_modified_since({DAY}, days => 20)": ("activity", adhoc.not_modified_since, (AS_OF, 20)),
    "activity_of_item('Customer#000000077')": ("raw", adhoc.item_events, ("Customer#000000077",)),
    "readiness_most_overdue()": ("readiness", adhoc.most_overdue_first, ()),
    "readiness_with_status()": ("readiness", adhoc.status_contains, ()),
    "readiness_with_status('Within')": ("readiness", adhoc.status_contains, ("Within",)),
    "readiness_exceeding()": ("readiness", adhoc.exceeding_items, ()),
    "readiness_within()": ("readiness", adhoc.within_items, ()),
    "readiness_unassessable()": ("readiness", adhoc.unassessable_items, ()),
}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("tables")))
    for table, rows in queries.sql_tables(spark, SF_DIR).items():
        store.overwrite(rows, table)
    assert sorted(sql.register(spark, store)) == sorted(sql.FUNCTIONS)
    return store


@pytest.mark.parametrize("call", sorted(PAIRS))
def test_function_equals_the_query(spark, store, call):
    table, query, arguments = PAIRS[call]
    want = query(store.load(table), *arguments)
    found = spark.sql(f"SELECT * FROM {call}")
    assert found.columns == want.columns and found.schema.simpleString() == want.schema.simpleString()
    rows = list(map(str, found.collect()))
    if "status" in call:
        assert sorted(rows) == sorted(map(str, want.collect()))
    else:
        assert rows == list(map(str, want.collect()))


def test_limits_filters_and_columns_of_the_caller(spark, store):
    first = spark.sql("SELECT item_name FROM readiness_exceeding() LIMIT 7").collect()
    assert first == adhoc.exceeding_items(store.load("readiness"), 7).select("item_name").collect()
    plan = spark.sql("SELECT item_name FROM retention_dated() WHERE item_type = 'Report'")._jdf.queryExecution().toString()
    assert "EqualTo(item_type,Report)" in plan
    lateral = spark.sql("SELECT n, count(*) AS c FROM VALUES (1), (2) AS t(n), LATERAL retention_by_type() GROUP BY n")
    assert len({r.c for r in lateral.collect()}) == 1


def test_only_functions_over_existing_tables(spark, tmp_path):
    empty = Store(spark, str(tmp_path))
    assert sql.register(spark, empty) == []
    empty.overwrite(inputs.inventory_table(spark, SF_DIR), "inventory")
    assert sql.register(spark, empty) == [n for n in sql.FUNCTIONS if n.startswith("retention_")]
