"""Shared folders, table reading, and vectorised views of text columns.

The numpy helpers work on the UTF-8 bytes of many texts at once: a part is a run of
consecutive texts, ``data`` their bytes and ``bounds`` where each of them starts and
ends.  A text is never split, so a part is as large as its texts need, and at least
one text long.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART_BYTES = 1 << 19
BATCH_BYTES = 8 * 1024 * 1024
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_own_shared: dict[str, str] = {}
_runs: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the driver ends.

    Where that is unset, as in tests, a local master uses a folder of its own; any
    other master is refused, since executors would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        key = spark.sparkContext.applicationId
        shared = _own_shared.setdefault(key, tempfile.mkdtemp(prefix="shelflife-llm-"))
    folder = f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
    _runs.append((spark, folder))
    return folder


def by_hash(rows: DataFrame, id_col: str, group_col: str, most: int) -> DataFrame:
    """At most ``most`` rows of each group, those whose id hashes lowest; ties by id.

    A hash threshold from the group's size leaves a few times as many before they are
    ranked, so a large group does not meet in one task.
    """
    sizes = rows.groupBy(group_col).agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.join(F.broadcast(sizes), group_col).where(draw * F.col("_n") < F.lit(4 * most + 100))
    rank = F.row_number().over(Window.partitionBy(group_col).orderBy(draw, id_col))
    return drawn.withColumn("_r", rank).where(F.col("_r") <= most).drop("_n", "_r")


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    Unless the session sets a limit, a batch for the workers holds ``BATCH_BYTES`` or so, as a task
    holds it several times over: in the executor's vectors, on its way and in the worker.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    key = spark.sparkContext.applicationId
    if key not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(tempfile.mkdtemp(prefix="shelflife-code-"), "shelflife_code")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "shelflife"))
        _shipped.add(key)


def place_of(rows: DataFrame, column: str) -> int | None:
    """Which column of ``rows`` that is, if text by exactly this name and one only, else None.

    Python then reads the text from a struct of all columns, and no copy of it goes along.
    """
    at = [i for i, field in enumerate(rows.schema.fields) if field.name.lower() == column.lower()]
    return at[0] if len(at) == 1 and rows.dtypes[at[0]] == (column, "string") else None


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _remove_runs() -> None:
    for spark, folder in _runs:
        try:
            remove(spark, folder)
        except Exception:  # the session has ended before
            return


def stage(rows: DataFrame, folder: str) -> DataFrame:
    """Write an intermediate result and read it back: computed once, lineage cut."""
    rows.write.mode("errorifexists").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def text_parts(
    column: pa.Array, limit: int = PART_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, bounds) over a string column; null is empty."""
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, flat[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def spans_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true values, cut where one text ends and the next begins."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    before[first] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    after[last] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with ASCII and Latin-1 letters in lower case; lengths stay."""
    data = _LOWER[data]
    # Letters with marks: C3 80..9E is the upper case of C3 A0..BE.
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    marked = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return np.where(marked, data + np.uint8(32), data)


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column from its flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next part."""
    if len(_powers[0]) < n:
        size = max(n, PART_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made = np.cumprod(steps, dtype=np.uint64)
            if size > 8 * PART_BYTES:  # a single very long text: not worth keeping
                if i == 0:
                    forth = made
                else:
                    return forth, made
            else:
                _powers[i] = made
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes wherever they lie."""
    forth, back = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * back[starts])


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive values."""
    n = max(len(values) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _BASE
        out += values[j : j + n]
    return mixed(out)


def sliding(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (np.minimum, np.maximum) over each window of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = of(out[: len(out) - step], out[step:])
        have += step
    return out
