"""Declared table schemas and typed frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """A schema from ``name type [not null], ...``; needs no running session."""
    parsed = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(c[0], _TYPES[c[1]], len(c) == 2) for c in parsed])


INVENTORY = _schema(
    "workspace_name string, workspace_id string, workspace_type string, item_name string, "
    "item_id string, item_type string, description string, created_date date, "
    "last_modified_date date, date_source string, age_days int, retention_period_days int, "
    "deletion_due_date date, is_overdue boolean, scan_date date"
)
EVENTS = _schema(
    "event_date date, event_timestamp timestamp_ntz, activity string, artifact_id string, "
    "artifact_name string, artifact_type string, workspace_id string, workspace_name string, "
    "user_id string, collection_date date"
)
ACTIVITY = _schema(
    "artifact_id string, artifact_name string, artifact_type string, workspace_id string, "
    "workspace_name string, first_modified_date date, last_modified_date date, "
    "modification_count bigint, latest_event_date date"
)
POLICY = _schema(
    "item_type string not null, retention_days int not null, action string, "
    "description string, updated_date string"
)
READINESS = _schema(
    "workspace_name string, item_name string, item_type string, last_modified_date date, "
    "retention_days int, days_since_modified int, days_overdue int, status string, "
    "date_source string, created_date date, report_date date, item_id string"
)

# One line per finished write of an activity day; the newest line of a day counts.
DAYS = _schema(
    "event_date date, n_rows bigint, n_blank bigint, n_nameless bigint, line bigint"
)
LANDED_DAYS = _schema("event_date date")
# A number per artifact, without gaps, and the artifacts of a day as bits by number.
NUMBERS = _schema("artifact_id string, number bigint")
BITMAPS = _schema("event_date date, line bigint, bucket bigint, bits binary")
# Fields of kept events that no spelling lists, one row each.
EXTRA = _schema("event_date date, event_timestamp timestamp_ntz, artifact_id string, key string, value string")
# Which days hold rows of which collection.
COLLECTIONS = _schema("collection_date date, event_date date")

# One landed page in source order, and one entry of a page in source order.
PAGE_SEQ = "struct<file:string,block:bigint,line:bigint>"
ENTRY_SEQ = "struct<file:string,block:bigint,line:bigint,pos:bigint>"


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema, in its column order."""
    return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def typed(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A frame from literal rows; a null in a not-null column is refused."""
    return spark.createDataFrame(rows, schema, verifySchema=True)


def entry_seq(page: str = "page_seq", pos: str = "pos") -> Column:
    """Order of one entry: its page's order plus its position in the page."""
    return F.struct(
        F.col(f"{page}.file").alias("file"),
        F.col(f"{page}.block").alias("block"),
        F.col(f"{page}.line").alias("line"),
        F.col(pos).cast("bigint").alias("pos"),
    )


def no_entry() -> Column:
    return F.lit(None).cast(ENTRY_SEQ)
