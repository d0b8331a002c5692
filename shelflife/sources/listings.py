"""Listings: workspaces, items, personal workspaces, listed lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.functions import fixed, text, times
from shelflife.operators.keep import keep_first
from shelflife.schemas import entry_seq
from shelflife.sources.pages import entries

_WORKSPACE = "array<struct<id:string,name:string,displayName:string,type:string,state:string,description:string>>"
_ITEM = "array<struct<id:string,name:string,displayName:string,type:string,workspaceId:string,description:string>>"
_USER = "array<struct<groupUserAccessRight:string,emailAddress:string,displayName:string,identifier:string>>"
_PERSONAL = f"array<struct<id:string,type:string,users:{_USER}>>"
_LAKE_TABLE = (
    "array<struct<name:string,tableName:string,displayName:string,type:string,format:string,"
    "lastUpdatedTimestamp:string,lastModifiedTimestamp:string>>"
)


def _or_unknown(*texts: Column) -> Column:
    return F.coalesce(*texts, F.lit(fixed.UNKNOWN))


def workspaces(pages: DataFrame) -> DataFrame:
    """Active workspaces from tenant-wide (``workspaces``) or per-user (``value``) pages."""
    found = entries(
        pages,
        f"workspaces {_WORKSPACE}, value {_WORKSPACE}",
        lambda body: F.coalesce(body["workspaces"], body["value"]),
    )
    return found.where(F.coalesce("e.state", F.lit("Active")) == "Active").select(
        F.col("e.id").alias("workspace_id"),
        _or_unknown(F.col("e.name"), F.col("e.displayName")).alias("workspace_name"),
        _or_unknown(F.col("e.type")).alias("workspace_type"),
        F.coalesce("e.description", F.lit("")).alias("description"),
        entry_seq().alias("seq"),
    )


def items(pages: DataFrame) -> DataFrame:
    """Items from bulk pages (``itemEntities``) or one workspace's pages (``value``).

    Pages of one workspace carry the workspace in a ``workspace_id`` column, usually
    the folder they landed in.
    """
    folder = F.col("workspace_id") if "workspace_id" in pages.columns else F.lit(None).cast("string")
    found = entries(
        pages,
        f"itemEntities {_ITEM}, value {_ITEM}",
        lambda body: F.coalesce(body["itemEntities"], body["value"]),
    )
    return found.select(
        F.coalesce("e.workspaceId", folder.cast("string"), F.lit("")).alias("workspace_id"),
        F.coalesce("e.id", F.lit("")).alias("item_id"),
        _or_unknown(F.col("e.name"), F.col("e.displayName")).alias("item_name"),
        _or_unknown(F.col("e.type")).alias("item_type"),
        F.coalesce("e.description", F.lit("")).alias("description"),
        entry_seq().alias("seq"),
    )


def personal_workspaces(pages: DataFrame, mask_personal: bool = True) -> DataFrame:
    """Personal workspaces with their owner: the first administrator, else the first user."""
    found = entries(pages, f"value {_PERSONAL}", lambda body: body["value"])
    users = F.coalesce("e.users", F.array().cast(_USER))
    admin = F.get(F.filter(users, lambda user: user["groupUserAccessRight"] == "Admin"), F.lit(0))
    first = F.get(users, F.lit(0))
    owner = F.coalesce(
        text.first_filled(
            admin["emailAddress"], admin["displayName"], admin["identifier"],
            first["emailAddress"], first["displayName"],
        ),
        F.lit(""),
    )
    kind = F.coalesce("e.type", F.lit("PersonalGroup"))
    return (
        found.where((kind == "PersonalGroup") & ~text.is_blank(F.col("e.id")))
        .select(F.col("e.id").alias("workspace_id"), owner.alias("owner"), entry_seq().alias("seq"))
        .withColumn("workspace_name", text.personal_label(F.col("owner"), mask_personal))
        .select("workspace_id", "owner", "workspace_name", "seq")
    )


def workspace_names(organisation: DataFrame, personal: DataFrame) -> DataFrame:
    """One name per workspace id: the last organisation entry, else the first personal one."""
    columns = ["workspace_id", "workspace_name"]
    org = keep_first(
        organisation.where(F.col("workspace_id").isNotNull()), ["workspace_id"], [F.desc("seq")]
    ).select(columns)
    own = keep_first(personal, ["workspace_id"], [F.asc("seq")]).select(columns)
    return org.unionByName(own.join(org.select("workspace_id"), "workspace_id", "left_anti"))


def lake_tables(pages: DataFrame) -> DataFrame:
    """Listed lake tables; pages carry the lakehouse in a ``lakehouse_id`` column.

    Unnamed entries and the reserved folder names are no tables.
    """
    found = entries(
        pages,
        f"data {_LAKE_TABLE}, value {_LAKE_TABLE}",
        lambda body: F.when(F.size(body["data"]) > 0, body["data"]).otherwise(body["value"]),
    )
    name = text.first_filled(F.col("e.name"), F.col("e.tableName"), F.col("e.displayName"))
    changed = text.first_filled(F.col("e.lastUpdatedTimestamp"), F.col("e.lastModifiedTimestamp"))
    return found.select(
        F.col("lakehouse_id").cast("string").alias("lakehouse_id"),
        name.alias("name"),
        _or_unknown(F.col("e.type")).alias("type"),
        _or_unknown(F.col("e.format")).alias("format"),
        times.parse_any(changed).alias("modified_ts"),
        entry_seq().alias("seq"),
    ).where(F.col("name").isNotNull() & ~text.is_reserved(F.col("name")))


