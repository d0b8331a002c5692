"""Landed response pages, and the entries they hold.

A page is one JSON document as the service returned it.  Following the paging
links is the landing job's work; here a folder of pages is one scan, and the
order of entries is (file, line, position in the page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str, one_page_per_file: bool = False) -> DataFrame:
    """Scan landed pages: JSON lines, or one page per file.

    Returns ``page_seq``, ``page`` and any partition column of the folder
    (``event_date=2024-01-31``).
    """
    return ordered_pages(located(spark.read.option("wholetext", one_page_per_file).text(path)))


def daily_pages(spark: SparkSession, path: str):
    """Landed pages by day: a function from days to their pages, which reads no other folder.

    Pages are numbered as they are read, and Spark prunes no folder by a filter on
    numbered rows, so the days have to be known before.
    """

    def of(days: list) -> DataFrame:
        lines = spark.read.text(path)
        return ordered_pages(located(lines.where(F.col("event_date").isin(days))))

    return of


def located(lines: DataFrame) -> DataFrame:
    """A text scan with the file block of every line."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def ordered_pages(lines: DataFrame) -> DataFrame:
    """Name the columns of a located scan and attach the page order.

    ``line`` only orders the lines of one file block.  It is taken on the scan itself,
    before any shuffle, so a recomputed task numbers its lines in the same order.
    """
    folders = [name for name in lines.columns if name not in ("value", "file", "block")]
    order = F.struct("file", "block", F.monotonically_increasing_id().alias("line"))
    return lines.select(order.alias("page_seq"), F.col("value").alias("page"), *folders)


def entries(pages: DataFrame, schema: str, pick) -> DataFrame:
    """One row per array entry: ``page_seq``, ``pos``, ``e`` and the page's other columns.

    ``pick`` maps the parsed page to the array to unnest.  A malformed page parses
    to null and yields no entry.
    """
    kept = [name for name in pages.columns if name != "page"]
    body: Column = F.from_json("page", schema)
    return pages.select(*kept, body.alias("body")).select(
        *kept, F.posexplode(pick(F.col("body"))).alias("pos", "e")
    )
