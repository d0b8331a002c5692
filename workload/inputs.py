"""The test tables dressed as the library's inputs.

Nations are workspaces, customers and suppliers are items, orders are scanner
entries, events are activity events, line items are paths and catalog objects, and
parts are listed tables.  Payload inputs are JSON pages, one per table row, so that
the library parses them as it would parse landed pages.  Nothing is left out of a
table; odd values (blank times, missing ids, other spellings) are planted by column
values.  The same views in SQL are in ``workload/oracle.py``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.operators import inventory
from shelflife.operators.joins import lookup_join
from shelflife.plans.daily import Landed, Settings
from shelflife.sources.store import freed_shuffles, scratch_folder

AS_OF = datetime(2024, 2, 15, 12)

# Order and ship dates end in 2001; moved by this many days they end near AS_OF.
SHIFT_DAYS = 8225

POLICY = {
    "Report": 900, "Notebook": 300, "Dataflow": 1200, "Workspace": 30,
    "Lakehouse": 10, "Warehouse": 20,
    "LakehouseTable": 2000, "LakehouseFile": 1000, "WarehouseTable": 400, "WarehouseView": 200,
}
DEFAULT_DAYS = 600

CUSTOMER, SUPPLIER, WORKSPACE, PERSONAL, STRANGER = 1, 2, 3, 4, 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  The large ones may come as one file with one row group, which one task
    would read and process alone; a table that many tasks read is left as it is."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in ("lineitem", "orders", "events") and not _by_many_tasks(rows, (sf_dir, name)):
        return rows.repartition(spark.sparkContext.defaultParallelism)
    return rows


_SPREAD: dict[tuple[str, ...], bool] = {}


def _by_many_tasks(rows: DataFrame, table: tuple[str, str]) -> bool:
    """Whether no task reads more than twice its share; of one file, the footer is asked, once."""
    if len(rows.inputFiles()) != 1:
        return True
    context = rows.sparkSession.sparkContext
    if (context.applicationId, *table) not in _SPREAD:
        counts = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        _SPREAD[context.applicationId, *table] = (counts[0] or 0) * context.defaultParallelism <= 2 * (counts[1] or 0)
    return _SPREAD[context.applicationId, *table]


_STORED: dict[tuple[str, str, str], str] = {}


def stored(build: Callable[[SparkSession, str], DataFrame]):
    """Write the frame once per application and set of tables; afterwards read the copy."""

    @wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _STORED:
            folder, rows = scratch_folder(spark), build(spark, sf_dir)
            with freed_shuffles(spark):
                if "event_date" in rows.columns:
                    by_day = rows.hint("rebalance", F.col("event_date")).write.partitionBy("event_date")
                    by_day.option("compression", "zstd").parquet(folder)
                else:
                    rows.write.option("compression", "zstd").parquet(folder)
            _STORED[key] = folder
        return spark.read.parquet(_STORED[key])

    return read


def guid(kind: int, key: Column) -> Column:
    """A GUID for a table key; the last digit tells what it identifies."""
    return F.concat(
        F.lpad(key.cast("string"), 8, "0"), F.lit(f"-0000-4000-8000-00000000000{kind}")
    )


def _page_seq(line: Column, block: Column | None = None, file: Column | None = None) -> Column:
    return F.struct(
        (F.lit("") if file is None else file).alias("file"),
        (F.lit(0) if block is None else block).cast("bigint").alias("block"),
        line.cast("bigint").alias("line"),
    ).alias("page_seq")


def _shifted(column: str, days: int = 0) -> Column:
    return F.date_add(F.to_date(column), SHIFT_DAYS + days).cast("timestamp_ntz")


def _one(condition: Column | None, **fields: Column) -> Column:
    """An array of one object, or nothing where the condition does not hold."""
    entry = F.array(F.struct(*[value.alias(name) for name, value in fields.items()]))
    return entry if condition is None else F.when(condition, entry)


def _body(**arrays: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in arrays.items()])).alias("page")


# Listings.


@stored
def workspace_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant-wide pages, and per-user pages for one region; one region has no types."""
    per_user = F.col("n_regionkey") == 4
    kind = F.when(F.col("n_regionkey") != 3, F.lit("Workspace"))
    ident, name = guid(WORKSPACE, F.col("n_nationkey")), F.col("n_name")
    return table(spark, sf_dir, "nation").select(
        _page_seq(F.col("n_nationkey")),
        _body(
            workspaces=_one(~per_user, id=ident, name=name, type=kind, state=F.lit("Active")),
            value=_one(per_user, id=ident, displayName=name, type=kind),
        ),
    )


def customer_type() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "AUTOMOBILE", "Report")
        .when(segment == "BUILDING", "Notebook")
        .when(segment == "FURNITURE", "Dataflow")
        .when(segment == "HOUSEHOLD", "MLModel")
    )


@stored
def item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in bulk pages; suppliers, as lakehouses and warehouses, in per-workspace pages."""
    bulk = table(spark, sf_dir, "customer").select(
        _page_seq(F.col("c_custkey"), file=F.lit("bulk")),
        _body(
            itemEntities=_one(
                None,
                id=guid(CUSTOMER, F.col("c_custkey")), name=F.col("c_name"), type=customer_type(),
                workspaceId=guid(WORKSPACE, F.col("c_nationkey")),
                description=F.when(F.col("c_acctbal") >= 0, F.lit("in use")),
            )
        ),
        F.lit(None).cast("string").alias("workspace_id"),
    )
    single = table(spark, sf_dir, "supplier").select(
        _page_seq(F.col("s_suppkey"), file=F.lit("single")),
        _body(
            value=_one(
                None,
                id=guid(SUPPLIER, F.col("s_suppkey")), displayName=F.col("s_name"),
                type=F.when(F.col("s_acctbal") >= 4500, "Lakehouse").otherwise("Warehouse"),
            )
        ),
        guid(WORKSPACE, F.col("s_nationkey")).alias("workspace_id"),
    )
    return bulk.unionByName(single)


@stored
def personal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal workspaces; some have an administrator, some only a member, some nobody,
    and some repeat an organisation workspace."""
    balance, name = F.col("s_acctbal"), F.col("s_name")

    def user(right: str, email: Column, display: Column) -> Column:
        return F.struct(
            F.lit(right).alias("groupUserAccessRight"), email.alias("emailAddress"),
            display.alias("displayName"), F.lit("u").alias("identifier"),
        )

    nothing = F.lit(None).cast("string")
    member = user("Member", nothing, name)
    admin = user("Admin", F.concat(F.lower(name), F.lit("@example.org")), nothing)
    users = F.when(balance >= 4500, F.array(member, admin)).when(balance >= 0, F.array(member))
    known = balance.between(1000, 2000)
    ident = F.when(known, guid(WORKSPACE, F.col("s_nationkey"))).otherwise(
        guid(PERSONAL, F.col("s_suppkey"))
    )
    return table(spark, sf_dir, "supplier").select(
        _page_seq(F.col("s_suppkey")),
        _body(value=_one(None, id=ident, type=F.lit("PersonalGroup"), users=users)),
    )


@stored
def lake_table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed tables of the lakehouses with low keys, under either array and any name field."""
    kind = F.col("p_type")
    name = F.concat(F.lit("t"), F.col("p_partkey").cast("string"))
    changed = F.date_format(
        F.lit("2023-06-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("p_size")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    entry = dict(
        name=F.when(kind == "ECONOMY", name).when(kind == "PROMO", F.lit("Tables")),
        tableName=F.when(kind == "STANDARD", name),
        displayName=F.when(kind.isNull() | ~kind.isin("ECONOMY", "PROMO", "STANDARD"), name),
        type=F.when(kind != "STANDARD", F.lit("Managed")),
        format=F.lit("delta"),
        lastUpdatedTimestamp=F.when(kind == "ECONOMY", changed),
        lastModifiedTimestamp=F.when(kind != "STANDARD", changed),
    )
    in_value = kind == "STANDARD"
    data = F.when(in_value, F.array().cast(_array_type(entry))).otherwise(_one(None, **entry))
    return table(spark, sf_dir, "part").select(
        guid(SUPPLIER, F.col("p_size") - 1).alias("lakehouse_id"),
        _page_seq(F.col("p_partkey")),
        _body(data=data, value=_one(in_value, **entry)),
    )


def _array_type(entry: dict[str, Column]) -> str:
    return "array<struct<" + ",".join(f"{name}:string" for name in entry) + ">>"


# Scans.


@stored
def scanner_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scanner page per order; its priority picks the array, its status spoils the time."""
    priority = F.col("o_orderpriority")
    ident = guid(CUSTOMER, F.col("o_custkey"))
    created = F.date_format(_shifted("o_orderdate", -200), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    modified = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(
        F.date_format(_shifted("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'")
    )
    workspace = F.array(
        F.struct(
            _one(priority == "1-URGENT", id=ident, createdDateTime=created, modifiedDateTime=modified).alias("reports"),
            _one(priority == "2-HIGH", id=ident, createdDate=created, modifiedDateTime=F.lit(""), modifiedDate=modified).alias("datasets"),
            _one(priority == "3-MEDIUM", objectId=ident, configuredBy=F.lit("someone"), modifiedDateTime=modified).alias("dataflows"),
            _one(priority == "4-NOT SPECIFIED", id=ident, createdDateTime=created).alias("dashboards"),
            _one(priority == "5-LOW", id=ident, createdDateTime=created, modifiedDate=modified).alias("datamarts"),
        )
    )
    return table(spark, sf_dir, "orders").select(
        _page_seq(F.col("o_orderkey")), _body(workspaces=workspace)
    )


@stored
def path_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed path per line item: tables with and without schema, files, log folders."""
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    part, order = F.col("l_partkey").cast("string"), F.col("l_orderkey").cast("string")
    name = (
        F.when(number == 1, F.concat(F.lit("Tables/dbo/t"), part))
        .when(number == 2, F.concat(F.lit("Tables/dbo/t"), part, F.lit("/part-"), order, F.lit(".parquet")))
        .when(number == 3, F.concat(F.lit("Tables/plain"), part))
        .when(number == 4, F.concat(F.lit("Tables/plain"), part, F.lit("/_delta_log/0.json")))
        .when(number == 5, F.concat(F.lit("Files/raw/"), part, F.lit("/"), order, F.lit(".csv")))
        .when(number == 6, F.concat(F.lit("Files/Tables/"), part, F.lit("/x.parquet")))
        .when(flag == "A", F.lit("Tables/Tables/stage"))
        .when(flag == "N", F.concat(F.lit("Files/Files/"), order, F.lit("/Files/Files/a.txt")))
        .otherwise(F.lit("Tables/TableMaintenance"))
    )
    is_dir = number.isin(1, 3) | ((number == 7) & (flag != "N"))
    changed = F.when(
        (flag == "R") & (F.col("l_linestatus") == "O"), F.lit("n/a")
    ).otherwise(F.date_format(_shifted("l_shipdate"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    return table(spark, sf_dir, "lineitem").select(
        guid(SUPPLIER, F.col("l_suppkey")).alias("lakehouse_id"),
        _page_seq(
            F.col("l_partkey"), block=F.col("l_orderkey"),
            file=F.concat(F.date_format("l_shipdate", "yyyyMMdd"), number.cast("string")),
        ),
        _body(
            paths=_one(
                None, name=name,
                isDirectory=F.when(is_dir, "true").when(F.col("l_linestatus") == "F", "False"),
                lastModified=changed,
            )
        ),
    )


def planted_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real folders and empty files, a table folder per part: some empty, some with a hidden
    folder, which may be empty too.  Returns ``lakehouse_id`` and ``root`` of each brand's tree."""
    top = scratch_folder(spark)
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit("-"))
    own = F.concat(F.lit("Tables/dbo/t"), key)
    names = F.array(
        F.concat(own, F.lit("/")),
        F.when(size % 5 != 0, F.concat(own, F.lit("/part-0.parquet"))),
        F.when(size % 3 == 0, F.concat(own, F.lit("/_delta_log/"))),
        F.when(size % 6 == 0, F.concat(own, F.lit("/_delta_log/0.json"))),
        F.when(size % 4 == 0, F.concat(F.lit("Files/raw/"), key, F.lit(".csv"))),
    )
    rows = table(spark, sf_dir, "part").select(
        F.concat_ws("/", F.lit(top), brand).alias("root"), F.explode(F.array_compact(names)).alias("name"),
        (F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + (F.col("p_partkey") % 8760) * 3600).alias("changed"),
    )

    def plant(batches):
        for batch in batches:
            for root, name, changed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                path = os.path.join(root, name)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                if not name.endswith("/"):
                    with open(path, "w"):
                        pass
                    os.utime(path, (changed, changed))
            yield batch.select(["root"])

    planted = rows.mapInArrow(plant, "root string").distinct()
    ident = F.element_at(F.split("root", "/"), -1)
    return spark.createDataFrame(planted.select(ident.alias("lakehouse_id"), "root").collect(), "lakehouse_id string, root string")


@stored
def warehouse_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        guid(SUPPLIER, F.col("l_suppkey")).alias("warehouse_id"),
        F.concat_ws("_", F.lit("o"), "l_orderkey", "l_partkey", "l_linenumber").alias("name"),
        F.col("l_linenumber").alias("schema_id"),
        F.when(flag == "A", "U").when(flag == "N", "V").otherwise("P").alias("type"),
        F.when(flag == "A", "USER_TABLE").when(flag == "N", "VIEW").otherwise("SQL_STORED_PROCEDURE").alias("type_desc"),
        _shifted("l_shipdate", -400).alias("create_date"),
        F.when(F.col("l_linestatus") == "F", _shifted("l_shipdate")).alias("modify_date"),
    )


@stored
def warehouse_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five schemas in every warehouse; objects of other numbers have no schema."""
    return table(spark, sf_dir, "supplier").select(
        guid(SUPPLIER, F.col("s_suppkey")).alias("warehouse_id"),
        F.explode(F.sequence(F.lit(1), F.lit(5))).alias("schema_id"),
    ).withColumn("name", F.concat(F.lit("schema_"), F.col("schema_id").cast("string")))


# Activity.


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the customer they name: user key + 10 + k, k being their property."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", k)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = events.withColumn("c_custkey", F.col("user_id") + 10 + F.col("k"))
    return named.join(customers, "c_custkey", "left").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )


def event_id_text() -> Column:
    kind, user = F.col("event_type"), F.col("user_id")
    return (
        F.when(kind == "error", guid(SUPPLIER, user))
        .when(kind == "signup", guid(STRANGER, user))
        .otherwise(guid(CUSTOMER, user))
    )


def event_workspace() -> Column:
    return (
        F.when(F.col("k") == 18, F.lit(""))
        .when(F.col("k") == 19, guid(STRANGER, F.lit(0)))
        .otherwise(F.coalesce(guid(WORKSPACE, F.col("c_nationkey")), F.lit("")))
    )


def event_activity() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "click", "UpdateItem").when(kind == "purchase", "RefreshDataset")
        .when(kind == "signup", "CreateItem").when(kind == "view", "ViewReport").otherwise("")
    )


def _iso_week(column: str) -> Column:
    """``2024-W03-2``: the year of the week's Thursday, the week and the day from Monday."""
    day = F.weekday(column)
    year = F.year(F.date_add(F.to_date(column), 3 - day))
    week = F.lpad(F.weekofyear(column).cast("string"), 2, "0")
    return F.concat(year.cast("string"), F.lit("-W"), week, F.lit("-"), (day + 1).cast("string"))


def event_time_text() -> Column:
    """The event's time in many spellings; some are blank and some are no time."""
    kind, k = F.col("event_type"), F.col("k")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        F.when(k == 13, F.lit(""))
        .when(k == 14, F.lit("not a time"))
        .when((k == 16) & (kind == "click"), F.date_format("ts", "EEE, dd MMM yy HH:mm:ss 'GMT'"))
        .when(k == 16, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(k == 20, F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS'Z'"))
        .when(k == 21, F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSSSSS"))
        .when(k == 22, F.concat(_iso_week("ts"), F.date_format("ts", "'T'HH:mm:ss.SSSSSS")))
        .when(kind == "click", F.concat(base, F.lit("Z")))
        .when(kind == "error", F.concat(base, F.lit("+05:00")))
        .when(kind == "purchase", F.concat(base, F.lit("7")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(base)
    )


def event_url() -> Column:
    """An address with two GUIDs, one or none."""
    head = F.lit("https://app.example.org/groups/")
    return (
        F.when(F.col("k") == 17, F.concat(head, F.lit("none")))
        .when(F.col("k") < 50, F.concat(head, event_workspace(), F.lit("/items/"), event_id_text()))
        .otherwise(F.concat(F.lit("https://app.example.org/items/"), event_id_text()))
    )


def event_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir).select("event_id", event_url().alias("url"))


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir).select("event_id", event_time_text().alias("text"))


@stored
def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per event, in folders by day; every kind of event spells its fields its own way."""
    kind, k = F.col("event_type"), F.col("k")

    def spelled(click: str, error: str, purchase: str, signup: str, view: str) -> Column:
        return (
            F.when(kind == "click", click).when(kind == "error", error)
            .when(kind == "purchase", purchase).when(kind == "signup", signup).otherwise(view)
        )

    ident = F.when(k != 15, F.when(kind == "purchase", event_url()).otherwise(event_id_text()))
    fields = F.create_map(
        spelled("Activity", "activity", "Activity", "Activity", "activity"), event_activity(),
        spelled("CreationTime", "creationTime", "CreationTime", "creationTime", "CreationTime"), event_time_text(),
        spelled("ArtifactId", "itemId", "ObjectId", "DatasetId", "artifactId"), ident,
        spelled("ArtifactName", "itemName", "DisplayName", "ObjectDisplayName", "artifactName"), F.col("c_name"),
        spelled("ItemType", "itemType", "ArtifactType", "artifactType", "ItemType"), F.initcap("event_type"),
        spelled("WorkSpaceId", "workSpaceId", "WorkspaceId", "WorkSpaceId", "WorkSpaceId"), event_workspace(),
        spelled("WorkspaceName", "workspaceName", "WorkspaceName", "WorkspaceName", "WorkspaceName"),
        F.when(k >= 30, F.col("n_name")),
        spelled("UserId", "userId", "UserId", "UserId", "userId"), F.col("user_id").cast("string"),
    )
    return _event_rows(spark, sf_dir).select(
        F.to_date("ts").alias("event_date"),
        _page_seq(F.col("event_id")),
        _body(activityEventEntities=F.array(fields)),
    )


@stored
def wider_event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with fields that no spelling lists: text, a number, an object, a flag, a null."""
    n = F.col("page_seq.line")

    def every(step: int, rest: int, *parts) -> Column:
        return F.when(n % step == rest, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))

    fields = F.concat_ws(
        "",
        every(4, 0, ',"ClientIP":"10.0.', (n % 256).cast("string"), '.1"'),
        every(4, 1, ',"Props":{"n":', (n % 7).cast("string"), ',"tags":["a","b"]}'),
        every(4, 2, ',"Duration":', (n % 100).cast("string"), ".5"),
        every(5, 0, ',"Ok":true'),
        every(6, 0, ',"Nothing":null'),
    )
    wider = F.concat(F.regexp_replace("page", r"\}\]\}\z", ""), fields, F.lit("}]}"))
    return event_pages(spark, sf_dir).withColumn("page", wider)


@stored
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw table: modification events, some with the workspace name still blank."""
    return (
        _event_rows(spark, sf_dir)
        .where(F.col("event_type") != "view")
        .select(
            F.to_date("ts").alias("event_date"),
            F.col("ts").alias("event_timestamp"),
            event_activity().alias("activity"),
            event_id_text().alias("artifact_id"),
            F.coalesce("c_name", F.lit("")).alias("artifact_name"),
            F.initcap("event_type").alias("artifact_type"),
            event_workspace().alias("workspace_id"),
            F.when(F.col("k") < 30, F.lit("")).otherwise(F.coalesce("n_name", F.lit(""))).alias("workspace_name"),
            F.col("user_id").cast("string").alias("user_id"),
            F.date_add(F.to_date("ts"), (F.col("k") / 50).cast("int")).alias("collection_date"),
        )
    )


# The stored inventory.


def inventory_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as items, line items as the sub-items of their supplier, all dated."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dates = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(dates, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    balance = F.col("c_acctbal")
    created = F.when(balance >= 0, _shifted("first_order", -200))
    modified = F.when(balance >= 3000, _shifted("last_order"))
    items = customers.select(
        F.col("n_name").alias("workspace_name"),
        guid(WORKSPACE, F.col("c_nationkey")).alias("workspace_id"),
        F.lit("Workspace").alias("workspace_type"),
        F.col("c_name").alias("item_name"),
        guid(CUSTOMER, F.col("c_custkey")).alias("item_id"),
        customer_type().alias("item_type"),
        F.lit("").alias("description"),
        created.alias("created_ts"),
        modified.alias("modified_ts"),
        F.when(F.coalesce(created, modified).isNull(), "none").otherwise("pbi_scanner").alias("date_source"),
        _row_seq(1, F.lit(""), F.lit(0), F.col("c_custkey")),
    )
    suppliers = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").alias("l_suppkey"), "s_suppkey", "s_name", "s_nationkey", "n_name")
    number, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    tail = (
        F.when(number == 1, F.concat(F.lit("/t"), part))
        .when(number == 2, F.lit("/Files"))
        .when(number == 3, F.concat(F.lit("/Files/raw/"), part, F.lit(".csv")))
        .when(number == 4, F.concat(F.lit("/Files/Tables/"), part))
        .when(number == 5, F.concat(F.lit("/dbo.t"), part))
        .when(number == 6, F.concat(F.lit("/dbo.v"), part))
        .otherwise(F.lit("/TableMaintenance"))
    )
    kind = (
        F.when(number.isin(1, 2, 7), "LakehouseTable").when(number.isin(3, 4), "LakehouseFile")
        .when(number == 5, "WarehouseTable").otherwise("WarehouseView")
    )
    sub_created = F.when(F.col("l_returnflag") != "N", _shifted("l_shipdate", -400))
    sub_modified = F.when(F.col("l_linestatus") == "F", _shifted("l_shipdate"))
    sub_items = (
        lookup_join(table(spark, sf_dir, "lineitem"), suppliers, ["l_suppkey"], "inner")
        .select(
            F.col("n_name").alias("workspace_name"),
            guid(WORKSPACE, F.col("s_nationkey")).alias("workspace_id"),
            F.lit("Workspace").alias("workspace_type"),
            F.concat("s_name", tail).alias("item_name"),
            guid(SUPPLIER, F.col("s_suppkey")).alias("item_id"),
            kind.alias("item_type"),
            F.lit("").alias("description"),
            sub_created.alias("created_ts"),
            sub_modified.alias("modified_ts"),
            F.when(F.coalesce(sub_created, sub_modified).isNull(), "none").otherwise("onelake_dfs").alias("date_source"),
            _row_seq(4, F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_orderkey"), F.col("l_partkey")),
        )
    )
    return items.unionByName(sub_items)


def _row_seq(producer: int, file: Column, block: Column, line: Column) -> Column:
    entry = F.struct(
        file.alias("file"), block.cast("bigint").alias("block"), line.cast("bigint").alias("line"),
        F.lit(0).cast("bigint").alias("pos"),
    )
    return inventory.row_seq(producer, entry, entry).alias("seq")


@stored
def scored_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory before dedup."""
    return inventory.scored(inventory_entries(spark, sf_dir), AS_OF, POLICY, DEFAULT_DAYS)


def inventory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory as a stored table, duplicates included: the reports must cope with them."""
    return scored_entries(spark, sf_dir).drop("seq")


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    """All landed inputs of one daily run."""
    return Landed(
        workspaces=workspace_pages(spark, sf_dir),
        items=item_pages(spark, sf_dir),
        personal=personal_pages(spark, sf_dir),
        scanner=scanner_pages(spark, sf_dir),
        events=event_pages(spark, sf_dir),
        lake_tables=lake_table_pages(spark, sf_dir),
        paths=path_pages(spark, sf_dir),
        warehouse_objects=warehouse_objects(spark, sf_dir),
        warehouse_schemas=warehouse_schemas(spark, sf_dir),
    )


SETTINGS = Settings(policy=POLICY, default_days=DEFAULT_DAYS, inventory_lookback_days=60, collector_lookback_days=60)
