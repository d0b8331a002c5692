"""Exact dedup by progressive refinement, with DataFrame functions only.

Rows are grouped by the length of their text, the survivors (groups of two or more) by
a hash of its beginning, and the survivors of that by a hash of all of it.  The full
hash is computed for survivors only: the surviving (length, prefix) pairs are broadcast
when few, so other texts are not hashed; when many, texts are hashed where they are
scanned, because moving texts would cost more than hashing them.  A caller who wants
the hash of every row anyway gets it from the first scan.  No text is ever shuffled.

Counts are summed before they are shuffled.  Both sides of a join back to the rows
are read from written tables, so adaptive execution can split the rows of a hot key.

Defined cases: null is the empty text, and empty texts are equal; rows that repeat an
id with equal text are members of one group, and all rows that carry the kept id are
marked kept; a null id is kept only if its group has no other; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.llm.shared import run_folder, stage

PREFIX_CHARS = 64
BROADCAST_KEYS = 500_000  # of 12 bytes each


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    broadcast_keys: int = BROADCAST_KEYS,
    hash_all: bool = False,
) -> DataFrame:
    """``id``, ``keep_id`` (largest id among equal texts), ``group_size``, ``kept``, ``hash``.

    One row per document row; ``hash`` is the SHA-256 of the text, null for rows that
    no full hash was needed for unless ``hash_all``.  Runs a job per round.
    """
    return _rounds(docs, id_col, text_col, prefix_chars, broadcast_keys, hash_all)[0]


def _measures(text: Column, prefix_chars: int) -> dict[str, Column]:
    return {"length": F.octet_length(text), "prefix": F.xxhash64(F.substring(text, 1, prefix_chars))}


def _rounds(
    docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, broadcast_keys: int, hash_all: bool
) -> tuple[DataFrame, DataFrame | None]:
    """The groups, and the (length, prefix) pairs that several rows have, None if many or not needed."""
    folder = run_folder(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    base = base.withColumns(_measures(F.col("text"), prefix_chars))
    hashed = F.sha2("text", 256).alias("hash")
    small = base.select("id", "length", "prefix", *([hashed] if hash_all else []))
    measured = stage(small, f"{folder}/measured")

    lengths = measured.groupBy("length").agg(F.count("*").alias("n")).where("n > 1")
    lengths = stage(lengths.select("length"), f"{folder}/lengths")
    prefixes = (
        measured.join(lengths, "length", "left_semi")
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("length", "prefix", F.lit(True).alias("shared"))
    )
    prefixes = stage(prefixes, f"{folder}/prefixes")

    keys = ["length", "prefix"]
    few = not hash_all and prefixes.count() <= broadcast_keys
    if hash_all:
        full = measured.join(prefixes, keys, "left")
    elif few:
        full = base.join(F.broadcast(prefixes), keys, "left")
        full = full.withColumn("hash", F.when(F.col("shared"), F.sha2("text", 256)))
    else:
        full = base.select("id", *keys, hashed).join(prefixes, keys, "left")
    full = stage(full.select("id", "shared", "hash"), f"{folder}/full")

    groups = (
        full.where("shared")
        .groupBy("hash")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    grouped = full.where("shared").join(stage(groups, f"{folder}/groups"), "hash")
    one = F.lit(1).cast("bigint").alias("group_size")
    alone = full.where("shared is null").select("id", F.col("id").alias("keep_id"), one, "hash")
    rows = grouped.select("id", "keep_id", "group_size", "hash").unionByName(alone)
    rows = rows.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    return rows, prefixes if few else None


def exact_deduped(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """The rows that stay, one per distinct text, with the columns they came with.

    Of rows that repeat the kept id and text, the one whose other columns hash lowest
    stays.  Rows that share no length and prefix stay where they are; the others' texts
    are hashed and shuffled once, to meet the ids that stay.  When many pairs of length
    and prefix are shared, that holds for all texts.
    """
    groups, prefixes = _rounds(docs, id_col, text_col, prefix_chars, broadcast_keys, hash_all=False)
    stay = groups.where("kept and hash is not null").select("id", F.col("hash").alias("h")).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("i"), text.alias("t"))
    alone = None
    if prefixes is not None:
        rows = rows.withColumns(_measures(F.col("t"), prefix_chars))
        shared = F.broadcast(prefixes)
        alone = rows.join(shared, ["length", "prefix"], "left_anti").select("doc.*")
        rows = rows.join(shared, ["length", "prefix"], "left_semi")
    rows = rows.select("doc", "i", F.sha2("t", 256).alias("hash"))
    met = rows.join(stay, F.col("i").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")))
    once = Window.partitionBy("id", "h").orderBy(F.xxhash64("doc"))
    kept = met.withColumn("n", F.row_number().over(once)).where("n = 1").select("doc.*")
    return kept if alone is None else alone.unionAll(kept)
