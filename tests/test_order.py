"""Row order of the sorted reports, against the same query with ORDER BY in SQL."""

import pytest

import twins

SF_DIR = "/root/testdata/sf0.001"

ITEM = "workspace_name NULLS FIRST, item_type NULLS FIRST, item_name NULLS FIRST, item_id NULLS FIRST"
# Columns beyond the sort's may differ among rows that tie, so only the listed ones are compared.
ORDERS = {
    "adhoc_listing": (ITEM, "workspace_name, item_type, item_name, item_id"),
    "adhoc_dated": ("last_modified_date DESC NULLS LAST", "last_modified_date"),
    "adhoc_overdue": ("age_days DESC NULLS LAST", "age_days"),
    "adhoc_by_workspace": ("workspace_name NULLS FIRST", "workspace_name"),
    "adhoc_by_type": ("total DESC, item_type NULLS FIRST", "item_type, total"),
    "readiness_by_type": ("overdue DESC, item_type NULLS FIRST", "item_type, overdue"),
    "readiness_by_workspace": ("overdue DESC, workspace_name NULLS FIRST", "workspace_name, overdue"),
    "readiness_most_overdue": (f"days_overdue DESC NULLS LAST, {ITEM}", "days_overdue, workspace_name, item_type, item_name, item_id"),
    "readiness_by_source": ("items DESC, date_source", "date_source, items"),
    "inventory_by_source": ("items DESC, date_source", "date_source, items"),
    "summary_newest": ("last_modified_date DESC NULLS LAST", "last_modified_date"),
    "daily_volume": ("event_date DESC", "event_date, events"),
    "activity_distribution_all": ("event_count DESC, activity", "activity, event_count"),
    "rows_per_collection": ("collection_date", "collection_date, row_count"),
    "latest_collection": ("event_date DESC, event_timestamp DESC", "event_date"),
    "stale_items": ("last_modified_date NULLS FIRST", "last_modified_date"),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    order, columns = ORDERS[name]
    names = columns.split(", ")
    frame = twins.QUERIES[name](spark, SF_DIR)
    got = [tuple(row[c] for c in names) for row in frame.collect()]
    with twins.connect(SF_DIR) as tables:
        columns_there = [d[0] for d in tables.execute(f"DESCRIBE {twins.ORACLE[name]}").fetchall()]
        keys = ", ".join(k for k in order.split(", ") if k.split()[0] in columns_there)
        want = tables.execute(f"SELECT {columns} FROM ({twins.ORACLE[name]}) ORDER BY {keys}").fetchall()
    assert len(got) > 0 and got == want
