"""Hot keys, null keys and the size check."""

import pytest
from pyspark.sql import functions as F

from helpers import plan
from shelflife.operators import joins


@pytest.fixture(scope="module")
def rows(spark):
    """A third of 3,000 rows share one key, some have none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 7 == 0, None).otherwise(
        F.concat(F.lit("k"), (n % 100).cast("string"))
    )
    return spark.range(0, 3000, 1, 6).select(n.alias("n"), key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    some = spark.range(0, 90).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value")
    )
    return some.union(spark.createDataFrame([("hot", -1), (None, -2)], "key string, value bigint"))


def as_set(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def small_skew(spark):
    """Skew handling at the size of these tables, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(rows, lookup, small_skew, how):
    spread = joins.spread_join(rows, lookup, ["key"], how)
    assert as_set(spread) == as_set(rows.join(lookup, ["key"], how).select(spread.columns))


def final_plan(frame):
    frame.collect()
    return plan(frame).split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


def test_hot_key_is_split_for_an_aggregated_lookup(spark, rows, lookup, small_skew):
    """The lookup is an aggregate on the join's key; its own shuffle would forbid the split."""
    totals = lookup.groupBy("key").agg(F.max("value").alias("value"))
    assert "skew=true" in final_plan(joins.spread_join(rows, totals, ["key"]))
    assert "skew=true" not in final_plan(rows.join(totals, ["key"], "left"))
    sizes = joins.spread_join(rows, totals, ["key"]).where("key = 'hot'").groupBy(F.spark_partition_id())
    counts = [r["count"] for r in sizes.count().collect()]
    assert len(counts) > 2 and sum(counts) == 1000


def test_any_number_of_hot_keys(spark, small_skew):
    """Two thousand keys of a hundred rows: every row is found, whatever is split."""
    many = spark.range(0, 200_000, 1, 8).select((F.col("id") % 2000).alias("key"), "id")
    totals = many.groupBy("key").agg(F.max("id").alias("last"))
    joined = joins.spread_join(many, totals, ["key"])
    assert joined.where(F.col("last") == 198_000 + F.col("key")).count() == 200_000


def test_null_keys_are_split(spark, small_skew):
    rows = spark.range(0, 5000, 1, 8).select(F.when(F.col("id") % 50 == 0, F.col("id")).alias("key"), "id")
    totals = rows.groupBy("key").agg(F.max("id").alias("last"))
    joined = joins.spread_join(rows, totals, ["key"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 5000 and joined.where("last is not null").count() == 100


def test_size_check(spark):
    assert joins.fits_broadcast(spark.range(10), max_rows=10)
    assert not joins.fits_broadcast(spark.range(11), max_rows=10)
    assert not joins.fits_broadcast(spark.range(10).withColumn("t", F.repeat(F.lit("x"), 99)), max_bytes=900)
    assert joins.fits_broadcast(spark.range(0))


def test_lookup_join_beyond_the_bound_is_spread(rows, lookup):
    assert "broadcast" in plan(joins.lookup_join(rows, lookup, ["key"])).lower()
    wide = joins.lookup_join(rows, lookup, ["key"], small=False)
    assert as_set(wide) == as_set(joins.lookup_join(rows, lookup, ["key"]))
