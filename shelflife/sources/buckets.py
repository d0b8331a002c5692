"""Stored tables whose rows lie by key, so that joins on the key move nothing.

A table has two parts.  The rows of ordinary keys are bucketed and sorted by the key: two
tables with the same number of buckets are joined, and aggregated, bucket by bucket where
they lie.  A bucket is read by one task, so keys with more than ``hot_rows`` rows, which
are counted before the table is written, stay out of the buckets, as do null keys; their
rows lie in a plain part and are left to the adaptive join.

Bucketing lives in the catalog: both parts are external tables below ``folder``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.operators.joins import lookup_join

HOT_ROWS = 1_000_000


@dataclass
class Bucketed:
    """A table by its two parts; ``name`` is its name in the catalog."""

    spark: SparkSession
    name: str
    key: str

    @property
    def lying(self) -> DataFrame:
        """The rows in buckets."""
        return self.spark.table(f"{self.name}_buckets")

    @property
    def loose(self) -> DataFrame:
        """The rows of hot keys and of none."""
        return self.spark.table(f"{self.name}_loose")

    @property
    def rows(self) -> DataFrame:
        return self.lying.unionByName(self.loose)

    def drop(self) -> None:
        """Forget the table; its files stay with the folder they are in."""
        for part in ("buckets", "loose"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")


def write_buckets(
    rows: DataFrame, name: str, key: str, buckets: int, folder: str, hot_rows: int = HOT_ROWS
) -> Bucketed:
    """Write a table by key: one file per bucket, sorted by the key.

    ``rows`` are read twice, so they should be a stored table or a cheap step from one.
    The hot keys are at most one in ``hot_rows`` rows.
    """
    spark = rows.sparkSession
    table = Bucketed(spark, name, key)
    table.drop()
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    hot = spark.createDataFrame(
        counted.where(F.col("n") > hot_rows).select(key).collect(), counted.select(key).schema
    )
    ordinary = rows.where(F.col(key).isNotNull())
    lying = lookup_join(ordinary, hot, [key], "left_anti").repartition(buckets, key)
    loose = rows.where(F.col(key).isNull()).unionByName(lookup_join(ordinary, hot, [key], "left_semi"))
    columns = rows.columns
    for part, frame in (("buckets", lying), ("loose", loose)):
        writer = frame.select(*columns).write.format("parquet").mode("overwrite")
        writer = writer.option("path", f"{folder.rstrip('/')}/{name}_{part}")
        if part == "buckets":
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{name}_{part}")
    return table
