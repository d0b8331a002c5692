"""How the test tables are dressed as inputs."""

import pyarrow as pa
import pyarrow.parquet as pq

from workload import inputs


def test_line_items_stay_where_they_are_for_their_few_suppliers(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = inputs.inventory_entries(spark, "/root/testdata/sf0.001")
        assert "SortMergeJoin [l_suppkey" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_file_that_many_tasks_read_is_not_dealt_again(spark, tmp_path):
    rows = pa.table({"l_orderkey": list(range(20_000))})
    for name, size in (("one", 20_000), ("many", 500)):
        (tmp_path / name).mkdir()
        pq.write_table(rows, tmp_path / name / "lineitem.parquet", row_group_size=size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        one, many = (inputs.table(spark, str(tmp_path / name), "lineitem") for name in ("one", "many"))
        assert "RoundRobinPartitioning" in one._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
        assert one.count() == many.distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
