"""Tables found by path, kept up to date from the difference of two listings.

A state row per folder (lakehouse, first segment, second segment) counts the entries that
speak for it, so that entries can be taken away again: a schema sign holds as long as some
entry supports it, a folder as long as any entry lies in it.  The first file and the last
folder entry are a minimum and a maximum, which a new entry can only improve on; a folder
that loses the very entry it holds is derived again from the listing, and only such
folders are.  The tables follow from the folders, which are far fewer than the paths.

Entries are compared as wholes, order included, so ``seq`` must be the same for an entry
that did not change: :func:`in_name_order` gives that to listings that land anew each day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.operators import discovery
from shelflife.operators.changes import row_key
from shelflife.operators.joins import lookup_join
from shelflife.schemas import ENTRY_SEQ
from shelflife.sources.store import scratch, stage
from shelflife.sources.versions import Versions

ENTRY = ["lakehouse_id", "name", "is_dir", "modified_ts", "seq"]
FOLDER = ["lakehouse_id", "head", "second"]
KEYS = {"folders": ["row_key"]}


def kept_folders(spark: SparkSession, folder: str) -> Versions:
    return Versions(spark, folder, KEYS)


def in_name_order(paths: DataFrame) -> DataFrame:
    """Paths in the order in which storage lists them, whatever page they came in."""
    none = F.lit(0).cast("bigint")
    seq = F.struct(F.col("name").alias("file"), none.alias("block"), none.alias("line"), none.alias("pos"))
    return paths.withColumn("seq", seq.cast(ENTRY_SEQ))


def listing_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries that one listing has more often than the other; ``weight`` is by how much.

    An entry whose date changed is one taken away and one added.
    """
    both = old.select(*ENTRY, F.lit(-1).alias("weight")).unionByName(new.select(*ENTRY, F.lit(1).alias("weight")))
    return both.groupBy(*ENTRY).agg(F.sum("weight").alias("weight")).where("weight <> 0")


def _moved(entries: DataFrame) -> DataFrame:
    """Per folder what weighted entries add up to, and the best that came and that went."""
    came, weight = F.col("weight") > 0, F.col("weight")

    def held(condition):
        return F.sum(F.when(condition, weight).otherwise(0))

    return entries.withColumn("row_key", row_key(*FOLDER)).groupBy("row_key", *FOLDER).agg(
        F.sum(weight).alias("n"),
        held(F.col("sign")).alias("n_sign"),
        held(F.col("file_entry").isNotNull()).alias("n_file"),
        held(F.col("dir_entry").isNotNull()).alias("n_dir"),
        F.min(F.when(came, F.col("file_entry"))).alias("first_file"),
        F.max(F.when(came, F.col("dir_entry"))).alias("last_dir"),
        F.min(F.when(~came, F.col("file_entry"))).alias("lost_file"),
        F.max(F.when(~came, F.col("dir_entry"))).alias("lost_dir"),
    )


COUNTS = ["n", "n_sign", "n_file", "n_dir"]
STATE = ["row_key", *FOLDER, *COUNTS, "first_file", "last_dir"]


def begin(kept: Versions, paths: DataFrame, as_of: datetime, ignore_partition_folders: bool = False) -> None:
    """The state of a whole listing."""
    entries = discovery.folder_entries(paths.withColumn("weight", F.lit(1)), ignore_partition_folders, ["weight"])
    version = kept.next_version()
    rows = _moved(entries).select(*STATE)
    kept.commit(version, as_of, {"folders": (True, kept.write("folders", version, rows))})


def update(
    kept: Versions,
    difference: DataFrame,
    listing: Callable[[], DataFrame],
    as_of: datetime,
    ignore_partition_folders: bool = False,
) -> int:
    """Bring the folders up to date from weighted entries; returns how many were derived again.

    ``listing`` gives the new listing; it is called, and read, only if some folder lost its
    first file or its last folder entry and still has others.
    """
    version = kept.next_version()
    with scratch(kept.spark) as folder:
        entries = discovery.folder_entries(difference, ignore_partition_folders, ["weight"])
        moved = stage(_moved(entries), f"{folder}/moved")
        state = lookup_join(kept.load("folders"), moved.select("row_key"), ["row_key"], "left_semi")
        old = state.select("row_key", *[F.col(c).alias(f"old_{c}") for c in (*COUNTS, "first_file", "last_dir")])
        merged = moved.join(old, "row_key", "left")
        for c in COUNTS:
            merged = merged.withColumn(c, F.col(c) + F.coalesce(f"old_{c}", F.lit(0)))
        # The held entry went if the least of those that went is it.
        file_went = F.coalesce(F.col("lost_file") <= F.col("old_first_file"), F.lit(False))
        dir_went = F.coalesce(F.col("lost_dir") >= F.col("old_last_dir"), F.lit(False))
        merged = merged.withColumns(
            {
                "again": (file_went & (F.col("n_file") > 0)) | (dir_went & (F.col("n_dir") > 0)),
                "first_file": F.when(F.col("n_file") > 0, F.least("first_file", "old_first_file")),
                "last_dir": F.when(F.col("n_dir") > 0, F.greatest("last_dir", "old_last_dir")),
            }
        )
        merged = stage(merged.select(*STATE, "again"), f"{folder}/merged")
        again = merged.where("again").select("row_key")
        n_again = again.count()
        changes = merged.drop("again")
        if n_again:
            own = discovery.folder_entries(listing(), ignore_partition_folders).withColumn("row_key", row_key(*FOLDER))
            found = lookup_join(own, again, ["row_key"], "left_semi").groupBy("row_key").agg(
                F.min("file_entry").alias("found_file"), F.max("dir_entry").alias("found_dir")
            )
            changes = merged.join(found, "row_key", "left").withColumns(
                {
                    "first_file": F.when(F.col("again"), F.col("found_file")).otherwise(F.col("first_file")),
                    "last_dir": F.when(F.col("again"), F.col("found_dir")).otherwise(F.col("last_dir")),
                }
            )
        changes = changes.select(*STATE).withColumn("gone", F.col("n") <= 0)
        changes = stage(changes, f"{folder}/changes")
        kept.commit(version, as_of, {"folders": kept.put("folders", version, changes)})
    return n_again


def tables(kept: Versions) -> DataFrame:
    """The tables the kept folders show, as :func:`~shelflife.operators.discovery.discovered_tables`."""
    folders = kept.load("folders").select(
        *FOLDER, (F.col("n_sign") > 0).alias("schema_sign"), "first_file", "last_dir"
    )
    return discovery.tables_in(folders)
