"""The ad-hoc queries as SQL: table functions over the stored tables.

``register`` makes the tables known to SQL by their names and defines a function per query;
then, for instance, ``SELECT * FROM activity_modified_since(DATE '2026-03-20', 7) LIMIT 50``.
Rows, columns and order are those of :mod:`shelflife.operators.adhoc`.  The functions belong
to the session; their bodies are planned into the query that calls them, so filters and
column selections of that query reach the scan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelflife.functions import fixed
from shelflife.sources.store import Store

_ITEM = "workspace_name, item_type, item_name, item_id"
_ARTIFACT = "workspace_name, artifact_type, artifact_name"
_DATES = (
    "workspace_name, item_name, item_type, created_date, last_modified_date, date_source,"
    " age_days, retention_period_days, deletion_due_date, is_overdue"
)
_VERDICT = "workspace_name, item_name, item_type, last_modified_date, date_source, days_since_modified, retention_days"
_SUMMARY = f"{_ARTIFACT}, last_modified_date, modification_count"

# (name and parameters, body); {inventory} and its like are the tables.
FUNCTIONS = {
    "retention_listing": ("", f"SELECT * FROM {{inventory}} ORDER BY {_ITEM}"),
    "retention_dated": (
        "",
        f"SELECT {_DATES} FROM {{inventory}} WHERE last_modified_date IS NOT NULL"
        f" ORDER BY last_modified_date DESC, {_ITEM}",
    ),
    "retention_overdue": (
        "",
        "SELECT workspace_name, item_name, item_type, age_days, retention_period_days, deletion_due_date,"
        f" date_source FROM {{inventory}} WHERE is_overdue ORDER BY age_days DESC, {_ITEM}",
    ),
    "retention_unknown_age": (
        "",
        f"SELECT workspace_name, item_name, item_type, date_source FROM {{inventory}} WHERE age_days IS NULL ORDER BY {_ITEM}",
    ),
    "retention_undated": (
        "",
        f"SELECT * FROM {{inventory}} WHERE date_source = '{fixed.SOURCE_NONE}' ORDER BY {_ITEM}",
    ),
    "retention_by_workspace": (
        "",
        "SELECT workspace_name, count(*) AS total_items, count_if(is_overdue) AS overdue,"
        " count_if(age_days IS NULL) AS no_date, round(avg(age_days), 1) AS avg_age_days"
        " FROM {inventory} GROUP BY workspace_name ORDER BY workspace_name",
    ),
    "retention_by_type": (
        "",
        "SELECT item_type, count(*) AS total, count_if(is_overdue) AS overdue, count_if(age_days IS NULL) AS no_date,"
        " min(age_days) AS min_age, max(age_days) AS max_age"
        " FROM {inventory} GROUP BY item_type ORDER BY total DESC, item_type",
    ),
    "activity_latest_collection": (
        "",
        "SELECT event_date, collection_date, activity, artifact_name, workspace_name FROM {raw}"
        " WHERE collection_date = (SELECT max(collection_date) FROM {raw})"
        " ORDER BY event_date DESC, event_timestamp DESC, artifact_id",
    ),
    "activity_newest": ("", f"SELECT {_SUMMARY} FROM {{activity}} ORDER BY last_modified_date DESC, {_ARTIFACT}"),
    "activity_modified_since": (
        "as_of DATE, days INT DEFAULT 7",
        f"SELECT {_SUMMARY} FROM {{activity}} WHERE last_modified_date >= date_sub(as_of, days)"
        f" ORDER BY last_modified_date DESC, {_ARTIFACT}",
    ),
    "activity_not_modified_since": (
        "as_of DATE, days INT DEFAULT 14",
        f"SELECT {_SUMMARY} FROM {{activity}} WHERE last_modified_date < date_sub(as_of, days)"
        f" ORDER BY last_modified_date, {_ARTIFACT}",
    ),
    "activity_of_item": (
        "name STRING",
        "SELECT event_date, event_timestamp, activity, user_id FROM {raw} WHERE artifact_name = name"
        " ORDER BY event_timestamp DESC, activity, user_id",
    ),
    "readiness_most_overdue": ("", f"SELECT * FROM {{readiness}} ORDER BY days_overdue DESC, {_ITEM}"),
    "readiness_with_status": ("word STRING DEFAULT 'EXCEEDS'", "SELECT * FROM {readiness} WHERE contains(status, word)"),
    "readiness_exceeding": (
        "",
        f"SELECT {_VERDICT}, days_overdue FROM {{readiness}} WHERE days_since_modified > retention_days"
        f" ORDER BY days_overdue DESC, {_ITEM}",
    ),
    "readiness_within": (
        "",
        f"SELECT {_VERDICT} FROM {{readiness}} WHERE days_since_modified <= retention_days"
        " ORDER BY item_type, workspace_name, item_name, item_id",
    ),
    "readiness_unassessable": (
        "",
        "SELECT workspace_name, item_name, item_type FROM {readiness} WHERE last_modified_date IS NULL"
        " ORDER BY item_type, workspace_name, item_name, item_id",
    ),
}

TABLES = ["inventory", "raw", "activity", "readiness"]


def register(spark: SparkSession, store: Store) -> list[str]:
    """Define the functions over the tables of a store that exist; returns their names.

    Tables kept in folders become temporary views by their names.
    """
    known = [table for table in TABLES if store.exists(table)]
    for table in known:
        if store.root is not None:
            store.load(table).createOrReplaceTempView(store.names[table])
    names = {table: f"`{store.names[table]}`" for table in known}
    made = []
    for name, (parameters, body) in FUNCTIONS.items():
        if all(f"{{{table}}}" not in body or table in names for table in TABLES):
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body.format(**names)}"
            )
            made.append(name)
    return made
