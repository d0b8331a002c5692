"""What changed between two states of a keyed relation.

Both sides meet in one aggregate on the key, so a task sends one row per key and side;
nothing is joined, and copies of a row are added up where they lie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflife.operators.joins import lookup_join


def row_key(*columns: str) -> Column:
    """One text for the values of several columns, null being a value like others."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


#: How the parts of a digest of several rows are put together, in any order of the rows.
DIGEST: dict[str, Callable[[str], Column]] = {"n": F.sum, "x": F.bit_xor, "s": F.sum}


def digest(*columns: str) -> list[Column]:
    """The parts of a row's digest: a count, 64 bits to be joined by xor, 32 bits to be summed."""
    values = [F.col(c) for c in columns]
    values += [v.isNull() for v in values]  # the hash passes over nulls
    low = F.xxhash64(F.lit(1), *values).bitwiseAND(F.lit((1 << 32) - 1))
    return [F.lit(1).cast("bigint").alias("n"), F.xxhash64(*values).alias("x"), low.alias("s")]


def difference(
    old: DataFrame, new: DataFrame, keys: list[str], measures: dict[str, Callable[[str], Column]]
) -> DataFrame:
    """The keys whose measures differ, with the new measures and ``gone``.

    Either side may hold several rows of a key; ``measures`` says how their columns are
    put together.  A key that only one side holds differs.
    """
    columns = [*keys, *measures]
    both = old.select(*columns, F.lit(True).alias("before")).unionByName(
        new.select(*columns, F.lit(False).alias("before"))
    )
    found = both.groupBy(*keys).agg(
        *[put(F.when(F.col("before"), F.col(c))).alias(f"was_{c}") for c, put in measures.items()],
        *[put(F.when(~F.col("before"), F.col(c))).alias(c) for c, put in measures.items()],
        F.bool_and("before").alias("gone"),
        F.bool_and(~F.col("before")).alias("added"),
    )
    same = ~F.col("gone") & ~F.col("added")
    for c in measures:
        same &= F.col(c).eqNullSafe(F.col(f"was_{c}"))
    return found.where(~same).select(*columns, "gone")


def touched_by(rows: DataFrame, deltas: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """The rows that a changed key reaches, each delta, which holds a key once, by its own columns.

    One pass over the rows: a delta that is measured small is broadcast, as it usually is.
    """
    marks = []
    for i, (delta, keys) in enumerate(deltas):
        marks.append(f"_touched_{i}")
        rows = lookup_join(rows, delta.select(*keys, F.lit(True).alias(marks[-1])), keys)
    return rows.where(F.coalesce(*marks, F.lit(False))).drop(*marks)
