"""Run a query in Spark and its SQL twin in DuckDB, and compare names, types and rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

from workload.oracle import ORACLE
from workload.queries import QUERIES

SPARK_TO_SQL = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def compare(spark, connection, sf_dir: str, name: str) -> None:
    """Raise with a short account of the first differences."""
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    spark_types = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in frame.schema.fields}
    described = connection.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    sql_types = {row[0]: row[1] for row in described}
    assert sql_types == spark_types, (sql_types, spark_types)
    rows = connection.execute(ORACLE[name])
    names = [column[0] for column in rows.description]
    order = [names.index(column) for column in columns]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in rows.fetchall())
    got = Counter(
        tuple(_plain(row[column]) for column in columns) for row in frame.select(columns).collect()
    )
    missing, extra = expected - got, got - expected
    assert not missing and not extra, (
        f"{name}: {sum(expected.values())} expected, {sum(got.values())} found; {columns}; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )
