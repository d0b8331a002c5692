"""Joins of many rows to a keyed lookup, safe against hot keys.

Adaptive execution splits the rows of a hot key, also of the null key, over many
tasks, whatever their number, as long as both sides of a join are shuffled for it and
for nothing else.  A lookup is usually an aggregate (one date per item, one name per
workspace) that sits directly on the join's shuffle; so it is rebalanced first, one
more shuffle of the small side.  Rows of a hot key that one input task read stay
together: a part is never larger than that task was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
BITMAP = 1 << 27  # bits: 16 MB at the most, read as blocks of 4 KB


def fits_broadcast(
    lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether a lookup is small; reads at most ``max_rows + 1`` of its rows."""
    width = F.octet_length(F.to_json(F.struct("*")))
    size = (
        lookup.limit(max_rows + 1)
        .agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(width), F.lit(0)).alias("n_bytes"))
        .first()
    )
    return size["n_rows"] <= max_rows and size["n_bytes"] <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join to a listing that is usually small: broadcast if measured small, else spread.

    The measurement is an action on the lookup, so the lookup should be a listing or
    a stored table, not a long computation; use :func:`spread_join` for those.
    ``small`` passes on the result of an earlier measurement.
    """
    if fits_broadcast(lookup) if small is None else small:
        return rows.join(F.broadcast(lookup), keys, how)
    return spread_join(rows, lookup, keys, how)


def spread_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Equi-join where ``rows`` may have hot or null keys; ``how`` must not keep lookup rows.

    Runs nothing by itself; hot keys are found from the shuffle's own statistics.
    """
    return rows.join(lookup.hint("rebalance"), keys, how)


def some_of(rows: DataFrame, node: str, wanted: DataFrame, bits: int = BITMAP) -> DataFrame:
    """``rows`` with ``_maybe``: false for sure where ``wanted`` does not hold the row's ``node``.

    Both hold hashes as ``node``.  The wanted ones are a bitmap, built with partial aggregates and
    broadcast, whose size does not depend on theirs; so rows that no join needs are not shuffled for it.
    """
    def block(of: Column) -> Column:
        return F.shiftright(F.pmod(of, F.lit(bits)), 15)

    def place(of: Column) -> Column:
        return F.pmod(of, F.lit(1 << 15))

    at = wanted.select(block(F.col(node)).alias("_block"), place(F.col(node)).alias("_place"))
    made = at.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    found = rows.join(F.broadcast(made), block(rows[node]) == F.col("_block"), "left")
    byte = F.substring("_bits", F.shiftright(place(F.col(node)), 3).cast("int") + 1, F.lit(1))
    bit = F.pmod(F.col(node), F.lit(8)).cast("int")
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    held = F.pmod(F.floor(value / F.pow(F.lit(2), bit)), F.lit(2)) == 1
    return found.withColumn("_maybe", F.coalesce(held, F.lit(False))).drop("_block", "_bits")
