"""Mixing sources to target weights along a curriculum, with DataFrame functions.

Every source has a weight and a schedule: how its rate changes over the training run,
a piecewise linear curve over time 0 to 1.  Targets share the budget by weight; a
source that cannot fill its share with ``max_repeat`` passes stops there and the rest
is shared again by weight.  A source's words are taken in an order drawn from a hash,
pass after pass, until its target is reached; the last document may be taken in part.
The integral of the schedule says how many words of the source were asked for by any
time; its inverse, a quadratic per segment, gives every copy of a document its place
in training, and a range sort by place gives the order.

Running sums go through (source, bucket): bucket totals are summed per source, and
only within a bucket of some ten thousand documents are rows ordered in one task, so
a source with a third of all rows is spread like any other.  The table of sources is
broadcast when it is counted small.

Defined cases: null text has no words and is not taken; a null source is a source,
last in order; ties in the hash are broken by id and size; a source without words has
target 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.llm.shared import run_folder, stage

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEAT = 3
BUCKET_ROWS = 16_384
BROADCAST_SOURCES = 100_000
#: Rate over time by weight class: light sources early, heavy ones late.
RAMPS = {1: [(0.0, 1.5), (1.0, 0.5)], 2: [(0.0, 1.0), (1.0, 1.0)], 3: [(0.0, 0.5), (1.0, 1.5)]}


def segments(knots: list[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(start, length, rate, slope, share before) of each piece, the whole integral being 1."""
    pieces, total = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
        pieces.append((t0, t1 - t0, r0, (r1 - r0) / (t1 - t0), total))
        total += (t1 - t0) * (r0 + r1) / 2
    return [(t, d, r / total, s / total, before / total) for t, d, r, s, before in pieces]


def place(share: Column, knots: list[tuple[float, float]]) -> Column:
    """The time by which a source has been asked for ``share`` of its words."""
    out = None
    for t, _, rate, slope, before in segments(knots):
        rest = share - F.lit(before)
        root = F.sqrt(F.lit(rate * rate) + F.lit(2 * slope) * rest)
        step = F.lit(2.0) * rest / (F.lit(rate) + root)
        step = F.when(rest > 0, step).otherwise(F.lit(0.0))
        here = F.lit(t) + step
        out = here if out is None else F.when(share >= F.lit(before), here).otherwise(out)
    return out


def targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``target`` per source from ``source``, ``source_size``, ``weight``: one row per source.

    Sources fill up in the order of what they can give per weight; those before the
    first that its share does not exhaust stop at what they can give, and its level holds
    for it and all after it.
    """
    cap = F.col("source_size") * F.lit(max_repeat)
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    return (
        sizes.withColumn("level", share)
        .withColumn("full", cap <= F.col("level") * F.col("weight"))
        .withColumn("rest", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("full"), cap.cast("double")).otherwise(F.col("rest") * F.col("weight")),
        )
        .drop("level", "full", "rest")
    )


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    ramps: dict[int, list[tuple[float, float]]] = RAMPS,
    max_repeat: int = MAX_REPEAT,
    seed: str = "mix",
) -> DataFrame:
    """``id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``, ``place``, ``places``.

    One row per document row, also those of which nothing is taken; ``places`` is where
    its copies stand, from 0 to 1, one for each pass that takes words of it, and
    ``place`` the first of them, null if nothing is taken.  Sources, in code point
    order, take the weights in turn.  Writes one table of small rows.
    """
    folder = run_folder(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0))
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed)))
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            size.cast("bigint").alias("size"),
            key.alias("key"),
        ),
        f"{folder}/rows",
    )
    digits = max(1, math.ceil(math.log(max(rows.count() / BUCKET_ROWS, 1), 16)))
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))

    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    buckets = stage(buckets, f"{folder}/buckets")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    sources = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("rank", F.row_number().over(ranked) - 1)
    sources = stage(
        targets(sizes=sources.withColumn("weight", weight), max_repeat=max_repeat),
        f"{folder}/sources",
    )
    small = sources.count() <= BROADCAST_SOURCES

    earlier = Window.partitionBy("source").orderBy("bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn(
        "bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))
    ).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "bucket_start")
    same_bucket = F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        rows.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
        .join(starts, same_bucket)
        .withColumn("start", F.col("bucket_start") + F.col("inside"))
        .select("id", "source", "size", "start")
    )

    per = sources.select(F.col("source").alias("s"), "source_size", "weight", "target")
    same = F.col("source").eqNullSafe(F.col("s"))
    rows = rows.join(F.broadcast(per) if small else per, same)
    goal = F.floor(F.col("target") + F.lit(0.5)).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0))
    part = F.col("goal") - F.col("passes") * F.col("source_size") - F.col("start")
    part = F.greatest(F.lit(0), F.least(part, F.col("size")))
    copies = []
    for n in range(max_repeat):
        begin, where = F.col("source_size") * F.lit(n) + F.col("start"), None
        for w, knots in sorted(ramps.items()):
            here = place(begin / F.col("goal"), knots)
            where = here if where is None else F.when(F.col("weight") == w, here).otherwise(where)
        copies.append(F.when((F.col("taken") > 0) & (begin < F.col("goal")), where))
    return (
        rows.withColumn("goal", goal)
        .withColumn("passes", passes)
        .withColumn("taken", F.col("passes") * F.col("size") + part)
        .withColumn("place", copies[0])
        .withColumn("places", F.array_compact(F.array(*copies)))
        .select("id", "source", "size", "source_size", "target", "taken", "place", "places")
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy of a document, range-sorted by place.

    ``copy`` counts the passes from 0, ``words`` is what is taken of the copy, the first
    so many; ``place`` is where the copy stands.
    """
    copies = mixed.where("taken > 0").drop("place").select("*", F.posexplode("places").alias("copy", "place"))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    return copies.withColumn("words", words).drop("places").orderBy("place", "source", "id", "copy")


def document_order(mixed: DataFrame) -> DataFrame:
    """One row per document row, range-sorted by the place of its first copy, those not taken last."""
    return mixed.orderBy(F.col("place").asc_nulls_last(), "source", "id")
