"""The same queries in SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

import re

from workload.inputs import DEFAULT_DAYS, POLICY, SHIFT_DAYS

AS_OF = "TIMESTAMP '2024-02-15 12:00:00'"
TODAY = "DATE '2024-02-15'"
NO_DATE = "⚪ No date — cannot assess"
EXCEEDS = "🔴 EXCEEDS RETENTION"
WITHIN = "🟢 Within retention"


def guid(kind: int, key: str) -> str:
    return f"(lpad(CAST({key} AS VARCHAR), 8, '0') || '-0000-4000-8000-00000000000{kind}')"


def shifted(column: str, days: int = 0) -> str:
    return f"({column} + INTERVAL {SHIFT_DAYS + days} DAY)"


RETENTION = (
    "CASE item_type "
    + " ".join(f"WHEN '{kind}' THEN {days}" for kind, days in POLICY.items())
    + f" ELSE {DEFAULT_DAYS} END"
)

INVENTORY = (
    "workspace_name, workspace_id, workspace_type, item_name, item_id, item_type, description, "
    "created_date, last_modified_date, date_source, age_days, retention_period_days, "
    "deletion_due_date, is_overdue, scan_date"
)


def scored(entries: str, extra: str = "", retention: str = RETENTION) -> str:
    """Inventory columns of dated entries."""
    return f"""
SELECT workspace_name, workspace_id, workspace_type, item_name, item_id, item_type, description,
       CAST(created_ts AS DATE) AS created_date, CAST(modified_ts AS DATE) AS last_modified_date,
       date_source,
       CAST(floor(date_diff('microsecond', ref, {AS_OF}) / 86400000000.0) AS INTEGER) AS age_days,
       days AS retention_period_days, CAST(ref + to_days(days) AS DATE) AS deletion_due_date,
       {AS_OF} > ref + to_days(days) AS is_overdue, {TODAY} AS scan_date{extra}
FROM (SELECT *, coalesce(modified_ts, created_ts) AS ref, CAST({retention} AS INTEGER) AS days FROM {entries})"""


def deduped(rows: str, order: str) -> str:
    return f"""
SELECT {INVENTORY} FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, item_type, item_name ORDER BY
    CASE WHEN last_modified_date IS NOT NULL THEN 0 WHEN created_date IS NOT NULL THEN 1 ELSE 2 END,
    {order}) AS rn FROM {rows}) WHERE rn = 1"""


def policy(inventory: str) -> str:
    return f"""
SELECT item_type, max(retention_period_days) AS retention_days, 'flag_only' AS action,
       'Retain ' || item_type || ' items for ' || max(retention_period_days) || ' day(s)' AS description,
       '2024-02-15' AS updated_date
FROM {inventory}
WHERE item_type IS NOT NULL
  AND NOT (item_type = 'LakehouseTable' AND regexp_matches(item_name, '/(Files|Tables|TableMaintenance)$'))
  AND NOT (item_type = 'LakehouseFile' AND contains(item_name, '/Files/Tables/'))
GROUP BY item_type"""


def assessed(inventory: str, summary: str, rules: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, item_type, item_name
    ORDER BY last_modified_date DESC NULLS LAST, workspace_name NULLS LAST, created_date NULLS LAST, date_source) AS rn
  FROM (
    SELECT *,
      CASE WHEN exceeds_retention THEN days_since_modified - retention_days ELSE 0 END AS days_overdue,
      CASE WHEN last_modified_date IS NULL THEN '{NO_DATE}' WHEN exceeds_retention THEN '{EXCEEDS}'
           ELSE '{WITHIN}' END AS status
    FROM (
      SELECT *, days_since_modified > retention_days AS exceeds_retention
      FROM (
        SELECT i.workspace_name, i.item_name, i.item_type, i.item_id, i.created_date, p.retention_days,
               coalesce(a.d, n.d, i.last_modified_date, i.created_date) AS last_modified_date,
               CASE WHEN a.d IS NOT NULL THEN 'activity_id_match' WHEN n.d IS NOT NULL THEN 'activity_name_match'
                    WHEN i.last_modified_date IS NOT NULL THEN 'fabric_api'
                    WHEN i.created_date IS NOT NULL THEN 'created_date' ELSE 'none' END AS date_source,
               CAST(date_diff('day', coalesce(a.d, n.d, i.last_modified_date, i.created_date), {TODAY}) AS INTEGER)
                 AS days_since_modified
        FROM {inventory} i
        LEFT JOIN (SELECT artifact_id, max(last_modified_date) AS d FROM {summary} GROUP BY 1) a
          ON a.artifact_id = i.item_id
        LEFT JOIN (SELECT lower(trim(workspace_name)) AS w, lower(trim(artifact_name)) AS t,
                          max(last_modified_date) AS d FROM {summary} GROUP BY 1, 2) n
          ON n.w = lower(trim(i.workspace_name)) AND n.t = lower(trim(i.item_name))
        LEFT JOIN {rules} p ON p.item_type = i.item_type
        WHERE NOT (i.item_type = 'LakehouseTable' AND regexp_matches(i.item_name, '/(Files|Tables|TableMaintenance)$'))
          AND NOT (i.item_type = 'LakehouseFile' AND contains(i.item_name, '/Files/Tables/'))
      )))) WHERE rn = 1"""


def readiness(report: str) -> str:
    return f"""
SELECT workspace_name, item_name, item_type, last_modified_date, retention_days, days_since_modified,
       days_overdue, status, date_source, created_date, {TODAY} AS report_date, item_id FROM {report}"""


def summary(raw: str) -> str:
    return f"""
SELECT artifact_id, artifact_name, artifact_type, workspace_id, workspace_name,
       CAST(min(event_timestamp) AS DATE) AS first_modified_date,
       CAST(max(event_timestamp) AS DATE) AS last_modified_date,
       count(*) AS modification_count, max(event_date) AS latest_event_date
FROM {raw} GROUP BY ALL"""


CUSTOMER_TYPE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Report' WHEN 'BUILDING' THEN 'Notebook' "
    "WHEN 'FURNITURE' THEN 'Dataflow' WHEN 'HOUSEHOLD' THEN 'MLModel' END"
)

# Shared relations; a query gets the ones it names, and the ones those name.
RELATIONS: dict[str, str] = {}

# Activity.

RELATIONS["ev"] = f"""
SELECT e.*, CAST(ts AS DATE) AS event_date, c_name, n_name,
       CASE event_type WHEN 'click' THEN 'UpdateItem' WHEN 'purchase' THEN 'RefreshDataset'
                       WHEN 'signup' THEN 'CreateItem' WHEN 'view' THEN 'ViewReport' ELSE '' END AS act,
       upper(event_type[1]) || event_type[2:] AS kind,
       CASE event_type WHEN 'error' THEN {guid(2, 'user_id')} WHEN 'signup' THEN {guid(9, 'user_id')}
                       ELSE {guid(1, 'user_id')} END AS id_text,
       CASE k WHEN 18 THEN '' WHEN 19 THEN {guid(9, '0')}
              ELSE coalesce({guid(3, 'c_nationkey')}, '') END AS ws_id,
       CASE WHEN k IN (13, 14, 16) THEN NULL WHEN event_type = 'signup' AND k NOT IN (20, 21, 22) THEN date_trunc('second', ts)
            ELSE ts END AS iso_ts,
       CASE WHEN k IN (13, 14) THEN NULL WHEN event_type = 'signup' AND k NOT IN (20, 21, 22) OR k = 16 THEN date_trunc('second', ts)
            ELSE ts END AS any_ts,
       CASE WHEN k = 15 OR (k = 17 AND event_type = 'purchase') THEN NULL
            WHEN event_type = 'error' THEN {guid(2, 'user_id')} WHEN event_type = 'signup' THEN {guid(9, 'user_id')}
            ELSE {guid(1, 'user_id')} END AS found_id
FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events) e
LEFT JOIN customer ON c_custkey = e.user_id + 10 + e.k
LEFT JOIN nation ON n_nationkey = c_nationkey"""

RELATIONS["names"] = f"""
SELECT {guid(3, 'n_nationkey')} AS workspace_id, n_name AS workspace_name FROM nation
UNION ALL
SELECT DISTINCT id, 'My workspace' FROM personal
WHERE id NOT IN (SELECT {guid(3, 'n_nationkey')} FROM nation)"""

RELATIONS["personal"] = f"""
SELECT CASE WHEN s_acctbal BETWEEN 1000 AND 2000 THEN {guid(3, 's_nationkey')} ELSE {guid(4, 's_suppkey')} END AS id,
       CASE WHEN s_acctbal >= 4500 THEN lower(s_name) || '@example.org' WHEN s_acctbal >= 0 THEN s_name
            ELSE '' END AS owner FROM supplier"""

RELATIONS["normalized"] = f"""
SELECT event_date, iso_ts AS event_timestamp, act AS activity, found_id AS artifact_id,
       coalesce(c_name, '') AS artifact_name, kind AS artifact_type, ws_id AS workspace_id,
       coalesce(nullif(CASE WHEN k >= 30 THEN n_name END, ''), l.workspace_name, 'My workspace') AS workspace_name,
       CAST(user_id AS VARCHAR) AS user_id, {TODAY} AS collection_date
FROM ev LEFT JOIN names l ON l.workspace_id = ws_id
WHERE found_id IS NOT NULL AND iso_ts IS NOT NULL AND event_type <> 'view'"""

RELATIONS["raw"] = """
SELECT event_date, ts AS event_timestamp, act AS activity, id_text AS artifact_id,
       coalesce(c_name, '') AS artifact_name, kind AS artifact_type, ws_id AS workspace_id,
       CASE WHEN k < 30 THEN '' ELSE coalesce(n_name, '') END AS workspace_name,
       CAST(user_id AS VARCHAR) AS user_id,
       event_date + CAST(floor(k / 50.0) AS INTEGER) AS collection_date
FROM ev WHERE event_type <> 'view'"""

RELATIONS["matched"] = """
SELECT r.* REPLACE (CASE WHEN coalesce(r.workspace_name, '') = '' THEN coalesce(l.workspace_name, r.workspace_name)
                         ELSE r.workspace_name END AS workspace_name)
FROM raw r LEFT JOIN names l ON l.workspace_id = r.workspace_id"""

RELATIONS["backfilled"] = """
SELECT * REPLACE (CASE WHEN coalesce(workspace_name, '') = ''
                        AND EXISTS (SELECT 1 FROM matched WHERE workspace_id <> '' AND coalesce(workspace_name, '') = '')
                       THEN 'My workspace' ELSE workspace_name END AS workspace_name) FROM matched"""

RELATIONS["summ"] = summary("raw")

RELATIONS["ranges"] = """
SELECT found_id AS artifact_id, min(any_ts) AS first_activity, max(any_ts) AS last_activity,
       coalesce(arg_min(c_name, ord) FILTER (c_name <> ''), '') AS name,
       coalesce(arg_min(ws_id, ord) FILTER (ws_id <> ''), '') AS workspace_id
FROM (SELECT *, date_diff('day', DATE '1970-01-01', event_date) * 100000000000 + event_id AS ord FROM ev)
WHERE found_id IS NOT NULL AND any_ts IS NOT NULL AND event_type <> 'view' GROUP BY found_id"""

RELATIONS["name_ranges"] = """
SELECT lower(trim(workspace_id)) AS ws_key, lower(trim(name)) AS name_key,
       min(first_activity) AS created, max(last_activity) AS modified
FROM ranges WHERE trim(workspace_id) <> '' AND trim(name) <> '' GROUP BY 1, 2"""

# Inventory.

RELATIONS["scan"] = f"""
SELECT {guid(1, 'o_custkey')} AS id,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN {shifted('o_orderdate', -200)} END AS created,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus <> 'P' THEN {shifted('o_orderdate')} END AS modified,
       'pbi_scanner' AS source
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""

RELATIONS["lookup"] = """
SELECT coalesce(s.id, r.artifact_id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.created ELSE r.first_activity END AS created,
       CASE WHEN s.modified IS NULL OR r.last_activity > s.modified THEN coalesce(r.last_activity, s.modified)
            ELSE s.modified END AS modified,
       coalesce(s.source, 'activity_events') AS source
FROM scan s FULL JOIN ranges r ON s.id = r.artifact_id"""

RELATIONS["ws"] = f"""
SELECT {guid(3, 'n_nationkey')} AS workspace_id, n_name AS workspace_name,
       CASE WHEN n_regionkey = 3 THEN 'Unknown' ELSE 'Workspace' END AS workspace_type, '' AS description,
       n_nationkey AS ord FROM nation"""

RELATIONS["listed_items"] = f"""
SELECT {guid(3, 'c_nationkey')} AS workspace_id, {guid(1, 'c_custkey')} AS item_id, c_name AS item_name,
       coalesce({CUSTOMER_TYPE}, 'Unknown') AS item_type,
       CASE WHEN c_acctbal >= 0 THEN 'in use' ELSE '' END AS description, 'bulk' AS shape, c_custkey AS ord FROM customer
UNION ALL
SELECT {guid(3, 's_nationkey')}, {guid(2, 's_suppkey')}, s_name,
       CASE WHEN s_acctbal >= 4500 THEN 'Lakehouse' ELSE 'Warehouse' END, '', 'single', s_suppkey FROM supplier"""

RELATIONS["entries"] = """
SELECT workspace_name, workspace_id, workspace_type, workspace_name AS item_name, workspace_id AS item_id,
       'Workspace' AS item_type, description, 0 AS producer, '' AS o1, ord AS o2, 0 AS o3 FROM ws
UNION ALL
SELECT w.workspace_name, w.workspace_id, w.workspace_type, i.item_name, i.item_id, i.item_type, i.description,
       1, i.shape, i.ord, 0 FROM listed_items i JOIN ws w ON w.workspace_id = i.workspace_id"""

RELATIONS["dated"] = """
SELECT e.*, CASE WHEN l.id IS NOT NULL THEN l.created ELSE n.created END AS created_ts,
       CASE WHEN l.id IS NOT NULL THEN l.modified ELSE n.modified END AS modified_ts,
       CASE WHEN l.id IS NOT NULL THEN l.source WHEN n.ws_key IS NOT NULL THEN 'activity_name_match'
            ELSE 'none' END AS date_source
FROM entries e LEFT JOIN lookup l ON l.id = e.item_id
LEFT JOIN name_ranges n ON n.ws_key = lower(e.workspace_id) AND n.name_key = lower(e.item_name)"""

ORDER_COLUMNS = ", producer, o1, o2, o3"
RELATIONS["catalogued"] = scored("dated", ORDER_COLUMNS)

RELATIONS["derived"] = f"""
SELECT c.* REPLACE (
    CASE WHEN fill THEN first_created ELSE created_date END AS created_date,
    CASE WHEN fill THEN last_modified ELSE last_modified_date END AS last_modified_date,
    CASE WHEN fill THEN 'derived_from_items' ELSE date_source END AS date_source,
    CASE WHEN fill THEN CAST(floor(date_diff('microsecond', CAST(ref AS TIMESTAMP), {AS_OF}) / 86400000000.0) AS INTEGER)
         ELSE age_days END AS age_days,
    CASE WHEN fill THEN CAST(ref + retention_period_days AS DATE) ELSE deletion_due_date END AS deletion_due_date,
    CASE WHEN fill THEN {TODAY} > ref + retention_period_days ELSE is_overdue END AS is_overdue)
FROM (SELECT b.*, first_created, last_modified, coalesce(last_modified, first_created) AS ref,
             b.item_type = 'Workspace' AND b.date_source = 'none'
               AND coalesce(last_modified, first_created) IS NOT NULL AS fill
      FROM catalogued b LEFT JOIN (
        SELECT workspace_id, min(created_date) AS first_created, max(last_modified_date) AS last_modified
        FROM catalogued WHERE item_type <> 'Workspace' GROUP BY workspace_id) USING (workspace_id)) c"""
RELATIONS["derived_rows"] = "SELECT * EXCLUDE (first_created, last_modified, ref, fill) FROM derived"

RELATIONS["parents"] = """
SELECT workspace_name, workspace_id, workspace_type, item_name AS parent_name, item_id AS parent_id, item_type AS parent_type
FROM entries WHERE item_type IN ('Lakehouse', 'Warehouse')"""

RELATIONS["listed"] = f"""
SELECT {guid(2, 'p_size - 1')} AS lakehouse_id, 't' || p_partkey AS name,
       CASE WHEN p_type = 'STANDARD' THEN 'Unknown' ELSE 'Managed' END AS type, 'delta' AS format,
       CASE WHEN p_type <> 'STANDARD' THEN TIMESTAMP '2023-06-01' + to_days(p_size) END AS modified_ts, p_partkey AS ord
FROM part WHERE p_type <> 'PROMO'"""

RELATIONS["pth"] = f"""
SELECT {guid(2, 'l_suppkey')} AS lakehouse_id,
       CASE l_linenumber WHEN 1 THEN 'Tables/dbo/t' || l_partkey
         WHEN 2 THEN 'Tables/dbo/t' || l_partkey || '/part-' || l_orderkey || '.parquet'
         WHEN 3 THEN 'Tables/plain' || l_partkey
         WHEN 4 THEN 'Tables/plain' || l_partkey || '/_delta_log/0.json'
         WHEN 5 THEN 'Files/raw/' || l_partkey || '/' || l_orderkey || '.csv'
         WHEN 6 THEN 'Files/Tables/' || l_partkey || '/x.parquet'
         ELSE CASE l_returnflag WHEN 'A' THEN 'Tables/Tables/stage'
              WHEN 'N' THEN 'Files/Files/' || l_orderkey || '/Files/Files/a.txt' ELSE 'Tables/TableMaintenance' END END AS name,
       l_linenumber IN (1, 3) OR (l_linenumber = 7 AND l_returnflag <> 'N') AS is_dir,
       CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O') THEN {shifted('l_shipdate')} END AS modified_ts,
       strftime(l_shipdate, '%Y%m%d') || l_linenumber AS o1, l_orderkey AS o2, l_partkey AS o3
FROM lineitem"""

RELATIONS["segs"] = """
SELECT *, list_filter(string_split(r2, '/'), lambda x: x <> '') AS parts
FROM (SELECT *, starts_with(r1, 'Tables/') AS nested,
             CASE WHEN starts_with(r1, 'Tables/') THEN substr(r1, 8) ELSE r1 END AS r2
      FROM (SELECT *, CASE WHEN starts_with(name, 'Tables/') THEN substr(name, 8) ELSE name END AS r1 FROM pth)
      WHERE r1 NOT IN ('Files', 'Tables') AND NOT starts_with(r1, 'Files/'))"""

RELATIONS["schema_dirs"] = """
SELECT DISTINCT lakehouse_id, parts[1] AS head FROM segs
WHERE (nested AND len(parts) >= 1 AND NOT starts_with(parts[1], '_'))
   OR (len(parts) >= 3 AND NOT starts_with(parts[2], '_'))"""

RELATIONS["file_tables"] = """
SELECT lakehouse_id, parts[2] AS name, modified_ts, o1, o2, o3 FROM segs
WHERE len(parts) >= 3 AND NOT starts_with(parts[2], '_')
QUALIFY row_number() OVER (PARTITION BY lakehouse_id, parts[2] ORDER BY o1, o2, o3) = 1"""

RELATIONS["dir_tables"] = """
SELECT g.lakehouse_id, g.parts[len(g.parts)] AS name, g.modified_ts, g.o1, g.o2, g.o3 FROM segs g
LEFT JOIN schema_dirs d ON d.lakehouse_id = g.lakehouse_id AND d.head = g.parts[1]
WHERE g.is_dir AND len(list_filter(g.parts, lambda x: starts_with(x, '_'))) = 0
  AND ((len(g.parts) = 1 AND d.head IS NULL) OR (len(g.parts) = 2 AND d.head IS NOT NULL))
QUALIFY row_number() OVER (PARTITION BY g.lakehouse_id, g.parts[len(g.parts)] ORDER BY g.o1 DESC, g.o2 DESC, g.o3 DESC) = 1"""

RELATIONS["path_tables"] = """
SELECT lakehouse_id, name, modified_ts, o1, o2, o3 FROM (
  SELECT * FROM dir_tables
  UNION ALL
  SELECT f.* FROM file_tables f ANTI JOIN dir_tables t ON t.lakehouse_id = f.lakehouse_id AND t.name = f.name)
WHERE name NOT IN ('Files', 'Tables', 'TableMaintenance')"""

RELATIONS["lake_table_entries"] = """
SELECT workspace_name, workspace_id, workspace_type, parent_name || '/' || name AS item_name, parent_id AS item_id,
       'LakehouseTable' AS item_type, 'Table in ' || parent_name || ' (' || type || ', ' || format || ')' AS description,
       CAST(NULL AS TIMESTAMP) AS created_ts, modified_ts,
       CASE WHEN modified_ts IS NOT NULL THEN 'lakehouse_tables_api' ELSE 'none' END AS date_source,
       2 AS producer, '' AS o1, ord AS o2, 0 AS o3
FROM listed JOIN parents ON parent_id = lakehouse_id AND parent_type = 'Lakehouse'
UNION ALL
SELECT workspace_name, workspace_id, workspace_type, parent_name || '/' || name, parent_id,
       'LakehouseTable', 'Table in ' || parent_name || ' (DFS discovered)', NULL, modified_ts,
       CASE WHEN modified_ts IS NOT NULL THEN 'onelake_dfs_tables' ELSE 'none' END, 3, o1, o2, o3
FROM path_tables JOIN parents ON parent_id = lakehouse_id AND parent_type = 'Lakehouse'
WHERE lakehouse_id NOT IN (SELECT lakehouse_id FROM listed)"""

RELATIONS["lake_file_entries"] = """
SELECT workspace_name, workspace_id, workspace_type,
       CASE WHEN starts_with(name, 'Files/Files/') THEN parent_name || '/Files/' || substr(name, 13)
            ELSE parent_name || '/' || name END AS item_name, parent_id AS item_id, 'LakehouseFile' AS item_type,
       'File in ' || parent_name AS description, CAST(NULL AS TIMESTAMP) AS created_ts, modified_ts,
       CASE WHEN modified_ts IS NOT NULL THEN 'onelake_dfs' ELSE 'none' END AS date_source, 4 AS producer, o1, o2, o3
FROM pth JOIN parents ON parent_id = lakehouse_id AND parent_type = 'Lakehouse'
WHERE NOT is_dir AND starts_with(name, 'Files/') AND NOT starts_with(name, 'Files/Tables/')"""

RELATIONS["objects"] = f"""
SELECT {guid(2, 'l_suppkey')} AS warehouse_id, 'o_' || l_orderkey || '_' || l_partkey || '_' || l_linenumber AS object_name,
       CASE l_returnflag WHEN 'A' THEN 'USER_TABLE' ELSE 'VIEW' END AS object_type, 'schema_' || l_linenumber AS schema_name,
       {shifted('l_shipdate', -400)} AS created,
       CASE WHEN l_linestatus = 'F' THEN {shifted('l_shipdate')} END AS modified
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
WHERE l_returnflag IN ('A', 'N') AND l_linenumber <= 5"""

RELATIONS["object_entries"] = """
SELECT workspace_name, workspace_id, workspace_type, parent_name || '/' || schema_name || '.' || object_name AS item_name,
       parent_id AS item_id, CASE object_type WHEN 'USER_TABLE' THEN 'WarehouseTable' ELSE 'WarehouseView' END AS item_type,
       object_type || ' in ' || parent_name || '.' || schema_name AS description, created AS created_ts,
       modified AS modified_ts, 'warehouse_sys_metadata' AS date_source, 5 AS producer,
       CAST(created AS VARCHAR) || coalesce(CAST(modified AS VARCHAR), '') AS o1, 0 AS o2, 0 AS o3
FROM objects JOIN parents ON parent_id = warehouse_id AND parent_type = 'Warehouse'"""

RELATIONS["all_sub_items"] = """
SELECT * FROM lake_table_entries UNION ALL SELECT * FROM lake_file_entries UNION ALL SELECT * FROM object_entries"""
RELATIONS["scored_sub_items"] = scored("all_sub_items", ORDER_COLUMNS)
RELATIONS["all_rows"] = """
SELECT * FROM derived_rows UNION ALL BY NAME SELECT * FROM scored_sub_items"""
RELATIONS["built"] = deduped("all_rows", "producer, o1, o2, o3")

# The stored inventory.

RELATIONS["inv_entries"] = f"""
SELECT *, CASE WHEN coalesce(created_ts, modified_ts) IS NULL THEN 'none' ELSE 'pbi_scanner' END AS date_source FROM (
  SELECT n_name AS workspace_name, {guid(3, 'c_nationkey')} AS workspace_id, 'Workspace' AS workspace_type, c_name AS item_name,
         {guid(1, 'c_custkey')} AS item_id, {CUSTOMER_TYPE} AS item_type, '' AS description,
         CASE WHEN c_acctbal >= 0 THEN {shifted('first_order', -200)} END AS created_ts,
         CASE WHEN c_acctbal >= 3000 THEN {shifted('last_order')} END AS modified_ts,
         1 AS producer, '' AS o1, 0 AS o2, c_custkey AS o3
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1)
    ON o_custkey = c_custkey)
UNION ALL
SELECT *, CASE WHEN coalesce(created_ts, modified_ts) IS NULL THEN 'none' ELSE 'onelake_dfs' END FROM (
  SELECT n_name, {guid(3, 's_nationkey')}, 'Workspace',
         s_name || CASE l_linenumber WHEN 1 THEN '/t' || l_partkey WHEN 2 THEN '/Files'
           WHEN 3 THEN '/Files/raw/' || l_partkey || '.csv' WHEN 4 THEN '/Files/Tables/' || l_partkey
           WHEN 5 THEN '/dbo.t' || l_partkey WHEN 6 THEN '/dbo.v' || l_partkey ELSE '/TableMaintenance' END,
         {guid(2, 's_suppkey')},
         CASE WHEN l_linenumber IN (1, 2, 7) THEN 'LakehouseTable' WHEN l_linenumber IN (3, 4) THEN 'LakehouseFile'
              WHEN l_linenumber = 5 THEN 'WarehouseTable' ELSE 'WarehouseView' END, '',
         CASE WHEN l_returnflag <> 'N' THEN {shifted('l_shipdate', -400)} END AS created_ts,
         CASE WHEN l_linestatus = 'F' THEN {shifted('l_shipdate')} END AS modified_ts,
         4, strftime(l_shipdate, '%Y%m%d'), l_orderkey, l_partkey
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)"""
RELATIONS["inv_rows"] = scored("inv_entries", ORDER_COLUMNS)
RELATIONS["inv"] = "SELECT * EXCLUDE (producer, o1, o2, o3) FROM inv_rows"

RELATIONS["rules"] = policy("inv")
RELATIONS["report"] = assessed("inv", "summ", "rules")
RELATIONS["ready"] = readiness("report")

# The fields of events that no spelling lists.
RELATIONS["wider"] = """
SELECT *, CAST('{' || substr(
    CASE WHEN event_id % 4 = 0 THEN ',"ClientIP":"10.0.' || event_id % 256 || '.1"' ELSE '' END
    || CASE WHEN event_id % 4 = 1 THEN ',"Props":{"n":' || event_id % 7 || ',"tags":["a","b"]}' ELSE '' END
    || CASE WHEN event_id % 4 = 2 THEN ',"Duration":' || event_id % 100 || '.5' ELSE '' END
    || CASE WHEN event_id % 5 = 0 THEN ',"Ok":true' ELSE '' END
    || CASE WHEN event_id % 6 = 0 THEN ',"Nothing":null' ELSE '' END, 2) || '}' AS JSON) AS fields FROM ev"""

# A real tree: every part has a folder; the folders above exist where something lies in them.
RELATIONS["tree"] = """
SELECT replace(p_brand, '#', '-') AS lakehouse_id, p_partkey AS k, p_size AS s, 'Tables/dbo/t' || p_partkey AS own,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (p_partkey % 8760) AS changed FROM part"""

RELATIONS["full_summ"] = summary("normalized")
RELATIONS["full_rules"] = policy("built")
RELATIONS["full_report"] = assessed("built", "full_summ", "full_rules")


def with_relations(query: str) -> str:
    """The query behind the shared relations it needs, in order of use."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in RELATIONS:
            if name not in order and re.search(rf"\b{name}\b", sql):
                body = RELATIONS[name]
                if body is not sql:
                    need(body)
                    if name not in order:
                        order.append(name)

    need(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in order) + "\n" + query


VERDICTS = """count(*) AS total, CAST(count(*) FILTER (exceeds_retention) AS BIGINT) AS overdue,
  CAST(count(*) FILTER (NOT exceeds_retention) AS BIGINT) AS within, count(*) FILTER (last_modified_date IS NULL) AS no_date"""

QUERIES = {
    # Readiness.
    "readiness_report": "SELECT * FROM ready",
    "readiness_by_change": "SELECT * FROM ready",
    "readiness_in_buckets": "SELECT * FROM ready",
    "policy_types": """SELECT item_type, count(*) AS item_count, max(retention_period_days) AS retention_days FROM inv
      WHERE NOT (item_type = 'LakehouseTable' AND regexp_matches(item_name, '/(Files|Tables|TableMaintenance)$'))
        AND NOT (item_type = 'LakehouseFile' AND contains(item_name, '/Files/Tables/')) GROUP BY 1""",
    "policy_table": "SELECT * FROM rules",
    "policy_override": """SELECT p.* REPLACE (coalesce(o.days, p.retention_days) AS retention_days) FROM rules p
      LEFT JOIN (SELECT item_type, max(retention_period_days) * 2 AS days FROM inv WHERE age_days IS NOT NULL GROUP BY 1) o USING (item_type)""",
    "readiness_by_type": f"""SELECT item_type, {VERDICTS}, max(days_since_modified) AS max_days_inactive,
      CAST(trunc(avg(days_since_modified)) AS INTEGER) AS avg_days_inactive FROM report GROUP BY item_type""",
    "readiness_by_workspace": f"SELECT workspace_name, {VERDICTS} FROM report GROUP BY workspace_name",
    "readiness_headline": f"SELECT {VERDICTS} FROM report",
    "readiness_by_source": "SELECT date_source, count(*) AS items FROM ready GROUP BY 1",
    "readiness_status_like": "SELECT * FROM ready WHERE status LIKE '%EXCEEDS%'",
    "readiness_most_overdue": "SELECT * FROM ready",
    "readiness_top_overdue": """SELECT workspace_name, item_name, item_type, last_modified_date, date_source,
      days_since_modified, retention_days, days_overdue FROM report WHERE exceeds_retention
      ORDER BY days_overdue DESC, workspace_name, item_type, item_name, item_id LIMIT 100""",
    "readiness_within": """SELECT workspace_name, item_name, item_type, last_modified_date, date_source,
      days_since_modified, retention_days FROM report WHERE NOT exceeds_retention
      ORDER BY item_type NULLS FIRST, workspace_name, item_name, item_id LIMIT 100""",
    "readiness_undated": """SELECT workspace_name, item_name, item_type FROM report WHERE last_modified_date IS NULL
      ORDER BY item_type NULLS FIRST, workspace_name, item_name, item_id LIMIT 50""",
    "readiness_all_overdue": """SELECT workspace_name, item_name, item_type, last_modified_date, date_source,
      days_since_modified, retention_days, days_overdue FROM report WHERE exceeds_retention""",
    "readiness_all_within": """SELECT workspace_name, item_name, item_type, last_modified_date, date_source,
      days_since_modified, retention_days FROM report WHERE NOT exceeds_retention""",
    "readiness_all_undated": "SELECT workspace_name, item_name, item_type FROM report WHERE last_modified_date IS NULL",
    # Activity.
    "events_normalized": "SELECT * FROM normalized",
    "events_unlisted_fields": """SELECT event_date, found_id AS artifact_id, key, json_extract_string(fields, '$.' || key) AS value
      FROM (SELECT event_date, found_id, fields, unnest(json_keys(fields)) AS key FROM wider)""",
    "events_by_variant": """SELECT event_date, found_id AS artifact_id, act AS activity,
      json_extract_string(fields, '$.ClientIP') AS "ClientIP", CAST(json_extract_string(fields, '$.Duration') AS DOUBLE) AS "Duration",
      CAST(json_extract_string(fields, '$.Ok') AS BOOLEAN) AS "Ok" FROM wider""",
    "events_unmasked": f"""SELECT event_date, iso_ts AS event_timestamp, act AS activity, found_id AS artifact_id,
      coalesce(c_name, '') AS artifact_name, kind AS artifact_type, ws_id AS workspace_id,
      coalesce(nullif(CASE WHEN k >= 30 THEN n_name END, ''), l.workspace_name, 'My workspace (' || user_id || ')') AS workspace_name,
      CAST(user_id AS VARCHAR) AS user_id, {TODAY} AS collection_date
      FROM ev LEFT JOIN names l ON l.workspace_id = ws_id
      WHERE found_id IS NOT NULL AND iso_ts IS NOT NULL AND event_type <> 'view'""",
    "collection_counters": """SELECT count(*) FILTER (ided) AS raw_events,
      count(*) FILTER (ided AND event_type = 'view') AS read_only_excluded,
      count(*) FILTER (ided AND event_type <> 'view' AND iso_ts IS NOT NULL) AS kept,
      count(*) FILTER (ided AND event_type NOT IN ('click', 'view')) AS recovered_by_fallback,
      count(*) FILTER (k <> 13 AND found_id IS NULL) AS dropped_without_id,
      count(*) FILTER (ided AND event_type <> 'view' AND iso_ts IS NOT NULL) AS named, CAST(0 AS BIGINT) AS unnamed
      FROM (SELECT *, k <> 13 AND found_id IS NOT NULL AS ided FROM ev)""",
    "ingest_counters": """SELECT count(*) FILTER (ided) AS raw_events,
      count(*) FILTER (ided AND event_type = 'view') AS read_only_excluded,
      count(*) FILTER (ided AND event_type <> 'view' AND iso_ts IS NOT NULL) AS kept,
      count(*) FILTER (ided AND event_type NOT IN ('click', 'view')) AS recovered_by_fallback,
      count(*) FILTER (k <> 13 AND found_id IS NULL) AS dropped_without_id,
      count(*) FILTER (ided AND event_type <> 'view' AND iso_ts IS NOT NULL) AS named, CAST(0 AS BIGINT) AS unnamed,
      count(*) FILTER (used AND k >= 30 AND n_name <> '') AS named_by_event,
      count(*) FILTER (used AND NOT coalesce(k >= 30 AND n_name <> '', false) AND coalesce(l.workspace_name, '') <> '') AS named_by_lookup,
      count(*) FILTER (used AND NOT coalesce(k >= 30 AND n_name <> '', false) AND coalesce(l.workspace_name, '') = '') AS named_by_label
      FROM (SELECT *, k <> 13 AND found_id IS NOT NULL AS ided,
        found_id IS NOT NULL AND iso_ts IS NOT NULL AND event_type <> 'view' AS used FROM ev) e
      LEFT JOIN names l ON l.workspace_id = ws_id""",
    "lookup_counters": """SELECT count(*) FILTER (total) AS total_events,
      count(*) FILTER (total AND event_type = 'view') AS read_only_excluded,
      count(*) FILTER (total AND event_type <> 'view') AS modification_events,
      count(DISTINCT found_id) FILTER (total AND event_type <> 'view') AS unique_items,
      count(*) FILTER (k <> 13 AND found_id IS NOT NULL AND event_type NOT IN ('click', 'view')) AS recovered_by_fallback,
      count(*) FILTER (k <> 13 AND found_id IS NULL) AS dropped_without_id
      FROM (SELECT *, found_id IS NOT NULL AND any_ts IS NOT NULL AS total FROM ev)""",
    "guid_extract": "SELECT event_id, CASE WHEN k <> 17 THEN id_text END AS guid FROM ev",
    "time_parse_iso": "SELECT event_id, iso_ts AS parsed FROM ev",
    "time_parse_mail": "SELECT event_id, any_ts AS parsed FROM ev",
    "missing_days_with_today": f"""SELECT event_date FROM (
      SELECT CAST(unnest(generate_series({TODAY} - 28, {TODAY}, INTERVAL 1 DAY)) AS DATE) AS event_date)
      WHERE event_date NOT IN (SELECT event_date FROM raw)""",
    "missing_days": f"""SELECT event_date FROM (
      SELECT CAST(unnest(generate_series({TODAY} - 28, {TODAY} - 1, INTERVAL 1 DAY)) AS DATE) AS event_date)
      WHERE event_date NOT IN (SELECT event_date FROM raw)""",
    "incremental_ingest": "SELECT * FROM normalized",
    "streamed_ingest": "SELECT * FROM normalized",
    "streamed_ingest_three_runs": "SELECT * FROM normalized",
    "ingest_after_crash": "SELECT * FROM normalized",
    "ingest_reset": "SELECT * FROM normalized",
    "name_backfill": "SELECT * FROM backfilled",
    "name_backfill_unmasked": """SELECT * REPLACE (CASE WHEN coalesce(workspace_name, '') = '' AND coalesce(user_id, '') <> ''
      AND EXISTS (SELECT 1 FROM matched WHERE workspace_id <> '' AND coalesce(workspace_name, '') = '')
      THEN 'My workspace (' || user_id || ')' ELSE workspace_name END AS workspace_name) FROM matched""",
    "backfill_accounting": """SELECT b AS blank_before, a AS blank_after, b - a AS fixed FROM
      (SELECT count(*) AS b FROM raw WHERE workspace_id <> '' AND coalesce(workspace_name, '') = '') x,
      (SELECT count(*) AS a FROM backfilled WHERE workspace_id <> '' AND coalesce(workspace_name, '') = '') y""",
    "activity_summary": "SELECT * FROM summ",
    "summary_incremental": "SELECT * FROM summ",
    "summary_streamed": "SELECT * FROM full_summ",
    "activity_coverage": """SELECT min(event_date) AS earliest, max(event_date) AS latest,
      count(DISTINCT event_date) AS days_covered, count(DISTINCT artifact_id) AS unique_items, count(*) AS total_events FROM raw""",
    "coverage_by_bitmaps": """SELECT min(event_date) AS earliest, max(event_date) AS latest,
      count(DISTINCT event_date) AS days_covered, count(DISTINCT artifact_id) AS unique_items, count(*) AS total_events FROM normalized""",
    "activity_by_type": """SELECT artifact_type, count(*) AS items, max(last_modified_date) AS most_recent_modification,
      CAST(trunc(avg(modification_count)) AS INTEGER) AS avg_modifications FROM summ GROUP BY 1""",
    "activity_by_workspace": """SELECT workspace_name, count(*) AS items,
      max(last_modified_date) AS most_recent_modification FROM summ GROUP BY 1""",
    "activity_distribution": """SELECT activity, count(*) AS event_count, count(DISTINCT artifact_id) AS unique_items
      FROM raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "activity_distribution_all": """SELECT activity, count(*) AS event_count, count(DISTINCT artifact_id) AS unique_items
      FROM raw GROUP BY 1""",
    "daily_volume": """SELECT event_date, count(*) AS events, count(DISTINCT artifact_id) AS unique_items FROM raw GROUP BY 1""",
    "rows_per_collection": "SELECT collection_date, count(*) AS row_count FROM raw GROUP BY 1",
    "latest_collection": """SELECT event_date, collection_date, activity, artifact_name, workspace_name FROM raw
      WHERE collection_date = (SELECT max(collection_date) FROM raw)""",
    "newest_collection": """SELECT event_date, collection_date, activity, artifact_name, workspace_name FROM normalized
      WHERE event_date >= DATE '2024-01-16'""",
    "item_events_stored": """SELECT event_date, event_timestamp, activity, user_id FROM normalized
      WHERE artifact_name = 'Customer#000000077'""",
    "summary_newest": "SELECT workspace_name, artifact_type, artifact_name, last_modified_date, modification_count FROM summ",
    "modified_last_days": f"""SELECT workspace_name, artifact_type, artifact_name, last_modified_date, modification_count
      FROM summ WHERE last_modified_date >= {TODAY} - 20""",
    "stale_items": f"""SELECT workspace_name, artifact_type, artifact_name, last_modified_date, modification_count
      FROM summ WHERE last_modified_date < {TODAY} - 20""",
    "item_events": """SELECT event_date, event_timestamp, activity, user_id FROM raw WHERE artifact_name = 'Customer#000000077'""",
    # Listings and scans.
    "workspaces": "SELECT workspace_id, workspace_name, workspace_type, description FROM ws",
    "items": "SELECT workspace_id, item_id, item_name, item_type, description FROM listed_items",
    "personal_workspaces": """SELECT id AS workspace_id, owner,
      'My workspace (' || CASE WHEN owner = '' THEN 'unknown' ELSE owner END || ')' AS workspace_name FROM personal""",
    "workspace_names": "SELECT * FROM names",
    "scanner_dates": "SELECT * FROM scan",
    "stored_tree": """SELECT lakehouse_id, own AS name, true AS is_dir, CAST(NULL AS TIMESTAMP) AS modified_ts FROM tree
      UNION ALL SELECT DISTINCT lakehouse_id, unnest(['Tables', 'Tables/dbo']), true, NULL FROM tree
      UNION ALL SELECT lakehouse_id, own || '/part-0.parquet', false, changed FROM tree WHERE s % 5 <> 0
      UNION ALL SELECT lakehouse_id, own || '/_delta_log', true, NULL FROM tree WHERE s % 3 = 0
      UNION ALL SELECT lakehouse_id, own || '/_delta_log/0.json', false, changed FROM tree WHERE s % 6 = 0
      UNION ALL SELECT DISTINCT lakehouse_id, unnest(['Files', 'Files/raw']), true, NULL FROM tree WHERE s % 4 = 0
      UNION ALL SELECT lakehouse_id, 'Files/raw/' || k || '.csv', false, changed FROM tree WHERE s % 4 = 0""",
    "stored_tree_tables": """SELECT DISTINCT lakehouse_id, 't' || k AS name FROM tree t
      WHERE EXISTS (SELECT 1 FROM tree o WHERE o.lakehouse_id = t.lakehouse_id AND o.s % 5 <> 0)
      UNION SELECT lakehouse_id, 'dbo' FROM tree GROUP BY 1 HAVING bool_and(s % 5 = 0)""",
    "lake_tables_listed": "SELECT lakehouse_id, name, type, format, modified_ts FROM listed",
    "path_listing": "SELECT lakehouse_id, name, is_dir, modified_ts FROM pth",
    # Inventory.
    "activity_range": "SELECT * FROM ranges",
    "activity_name_range": "SELECT * FROM name_ranges",
    "date_lookup": "SELECT * FROM lookup",
    "catalog_items": f"SELECT {INVENTORY} FROM catalogued",
    "scored_inventory": "SELECT * FROM inv",
    "scored_default_policy": scored(
        "inv_entries", retention="CASE WHEN item_type IN ('Report', 'SemanticModel') THEN 20 ELSE 2 END"
    ),
    "workspace_derived": f"SELECT {INVENTORY} FROM derived_rows",
    "inventory_deduped": deduped("inv_rows", "producer, o1, o2, o3"),
    "lake_tables_by_path": "SELECT lakehouse_id, name, modified_ts FROM path_tables",
    "lake_tables_by_change": "SELECT lakehouse_id, name, modified_ts FROM path_tables",
    "lake_tables_discovered": scored("lake_table_entries"),
    "lake_files": scored("lake_file_entries"),
    "warehouse_catalog": "SELECT * FROM objects",
    "warehouse_objects": scored("object_entries"),
    "inventory_headline": """SELECT count(DISTINCT workspace_name) AS workspaces, count(*) AS objects,
      count(last_modified_date) AS with_modified_date, count(*) FILTER (last_modified_date IS NULL) AS without_modified_date FROM inv""",
    "sub_item_counts": """SELECT item_type, count(*) AS items, count(coalesce(last_modified_date, created_date)) AS with_dates
      FROM inv WHERE item_type IN ('LakehouseTable', 'LakehouseFile', 'WarehouseTable', 'WarehouseView') GROUP BY 1""",
    "inventory_by_source": """SELECT date_source, count(*) AS items, count(last_modified_date) AS has_date FROM inv GROUP BY 1""",
    "inventory_by_workspace": """SELECT workspace_name, count(*) AS total_objects, count(last_modified_date) AS has_modified_date,
      CAST(sum(CAST(is_overdue AS INTEGER)) AS BIGINT) AS overdue_count FROM inv GROUP BY 1""",
    "inventory_by_type": """SELECT item_type, count(*) AS total, count(last_modified_date) AS has_modified_date,
      CAST(sum(CAST(is_overdue AS INTEGER)) AS BIGINT) AS overdue, CAST(trunc(avg(age_days)) AS INTEGER) AS avg_age_days
      FROM inv GROUP BY 1""",
    "adhoc_by_workspace": """SELECT workspace_name, count(*) AS total_items, count(*) FILTER (is_overdue) AS overdue,
      count(*) FILTER (age_days IS NULL) AS no_date, round(avg(age_days), 1) AS avg_age_days FROM inv GROUP BY 1""",
    "adhoc_by_type": """SELECT item_type, count(*) AS total, count(*) FILTER (is_overdue) AS overdue,
      count(*) FILTER (age_days IS NULL) AS no_date, min(age_days) AS min_age, max(age_days) AS max_age FROM inv GROUP BY 1""",
    "adhoc_listing": "SELECT * FROM inv",
    "adhoc_dated": """SELECT workspace_name, item_name, item_type, created_date, last_modified_date, date_source, age_days,
      retention_period_days, deletion_due_date, is_overdue FROM inv WHERE last_modified_date IS NOT NULL""",
    "adhoc_overdue": """SELECT workspace_name, item_name, item_type, age_days, retention_period_days, deletion_due_date,
      date_source FROM inv WHERE is_overdue""",
    "adhoc_unknown_age": "SELECT workspace_name, item_name, item_type, date_source FROM inv WHERE age_days IS NULL",
    "adhoc_undated": "SELECT * FROM inv WHERE date_source = 'none'",
    # Sinks and the whole job.
    "snapshot_roundtrip": deduped("inv_rows", "producer, o1, o2, o3"),
    "export_report": "SELECT * FROM ready",
    "export_roundtrip": """SELECT * REPLACE (CASE coalesce(days_since_modified, 0) % 6
      WHEN 1 THEN item_name || chr(10) || 'second line' WHEN 2 THEN 'say "' || item_name || '", ok'
      WHEN 3 THEN '  ' || item_name || ' ' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE item_name END AS item_name) FROM ready""",
    "full_inventory": "SELECT * FROM built",
    "full_run": readiness("full_report"),
    "full_run_by_change": readiness("full_report"),
}

# The same queries through SQL functions.
for function, query in {
    "sql_overdue": "adhoc_overdue", "sql_by_type": "adhoc_by_type", "sql_latest_collection": "latest_collection",
    "sql_item_events": "item_events", "sql_stale_items": "stale_items", "sql_exceeding": "readiness_all_overdue",
}.items():
    QUERIES[function] = QUERIES[query]

ORACLE = {name: with_relations(sql) for name, sql in QUERIES.items()}
