"""SimHash near-dedup through a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes.  Two that differ in at most two bits share at
least six of them, so the index lists fingerprints by positional bytes, pairs that
meet in a list tally the bytes they share, pairs with six or more are retained, and
the differing bits of those are counted.

Lists of a single (position, byte) would hold a 256th of all fingerprints each.  The
bytes are therefore listed in conjunctions: of the four pairs of neighbouring bytes, a
pair with six shared bytes shares two whole ones, so each fingerprint goes to six lists
keyed by four positional bytes, and every pair within reach meets in one of them.  A
list longer than ``LONG_LIST`` is not compared; its members go on to lists keyed by two
further positional bytes (six shared bytes in all), which hold 65,536 fingerprints at
the most, whatever the data.  No candidate is dropped.

Copies are collapsed first: only distinct fingerprints are listed.  Within a list of
more than ``PAIRWISE`` members nothing is compared in pairs; members that agree on two
further bytes look up the fingerprints one or two bits away.  A list reports a tree of
links instead of all of them, so what leaves it grows with its members.

Components are then found by large-star and small-star rounds over the links, each a
written table, so a hub's rows are split by adaptive execution and lost executors cost
their tasks alone.

Defined cases: null, empty and wordless texts have fingerprint zero, linked like any
other; fewer words than a shingle make one shingle; repeated rows are reported each
time; a null id is ignored as a component's name; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.llm.shared import remove, run_folder, ship, stage

SHINGLE = 3
BITS = 2
SEED = 42
LONG_LIST = 1 << 16
PAIRWISE = 64

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: Two pairs of neighbouring bytes, as numbers of 16-bit blocks from the top.
_FOUR = list(combinations(range(4), 2))
_TWO = list(combinations(range(8), 2))
_NEAR = [1 << a for a in range(16)] + [1 << a | 1 << b for a, b in combinations(range(16), 2)]


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()
    n = len(words) - size + 1
    if not words:
        return 0
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    spans = zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)
    of = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([of(joined[a:b], seed) for a, b in spans]), np.uint8)
    hashes = hashes.reshape(n, 8)
    if n < 256:
        counts = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate(
            [np.bincount(hashes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)]
        )
    return int.from_bytes(np.packbits(2 * counts > n).tobytes())


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).fill_null("").cast(pa.binary())
        made = np.fromiter((fingerprint(x.as_py(), size) for x in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(made.view(np.int64))], ["id", "fp"]
        )


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed number) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = rows.select("id", F.lit(0).cast("bigint").alias("fp")).schema
    return rows.mapInArrow(lambda batches: _fingerprints(batches, size), schema)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Number of zero bytes: the tally of positional bytes that two fingerprints share."""
    return (x[..., None].view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=-1)


def linked_pairs(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which pairs share enough positional bytes and then differ in few enough bits."""
    x = a ^ b
    keep = shared_bytes(x) >= 8 - bits
    keep[keep] = np.bitwise_count(x[keep]) <= bits
    return keep


def _tree(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link per member but one: (member, smallest member)."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, u, label[v])
        np.minimum.at(new, v, label[u])
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def list_links(fps: np.ndarray, four: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree of the links among distinct fingerprints of one list of four shared bytes."""
    if len(fps) <= PAIRWISE:
        i, j = np.triu_indices(len(fps), 1)
        keep = linked_pairs(fps[i], fps[j])
        return fps[i[keep]], fps[j[keep]]
    found_a, found_b = [], []
    free = [i for i in range(4) if i not in _FOUR[four]]
    places = [48 - 16 * i + 8 * half for i in free for half in (0, 1)]
    for left in combinations(places, 2):  # two bytes that may differ; all others are shared
        mask = np.uint64(0)
        for p in left:
            mask |= np.uint64(0xFF) << np.uint64(p)
        rest = fps & ~mask
        order = np.lexsort((fps, rest))
        s, r = fps[order], rest[order]
        cuts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]]))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo < 2:
                continue
            a, b = six_links(s[lo:hi], left)
            found_a.append(a)
            found_b.append(b)
    if not found_a:
        return fps[:0], fps[:0]
    return _tree(np.concatenate(found_a), np.concatenate(found_b))


def six_links(fps: np.ndarray, left: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that differ at most in the bytes at the two bit places."""
    if len(fps) <= PAIRWISE:
        i, j = np.triu_indices(len(fps), 1)
        keep = linked_pairs(fps[i], fps[j])
        return fps[i[keep]], fps[j[keep]]
    low, high = (np.uint64(p) for p in left)
    at = (fps >> low & np.uint64(0xFF)) | (fps >> high & np.uint64(0xFF)) << np.uint64(8)
    at = at.astype(np.int64)
    holder = np.full(1 << 16, -1)
    holder[at] = np.arange(len(fps))
    pairs = []
    for mask in _NEAR:
        other = holder[at ^ mask]
        ok = np.flatnonzero(other > np.arange(len(fps)))
        pairs.append(np.stack([ok, other[ok]]))
    i, j = np.concatenate(pairs, axis=1)
    keep = linked_pairs(fps[i], fps[j])
    return _tree(fps[i[keep]], fps[j[keep]])


def six_keys(fps: np.ndarray, number: int) -> np.ndarray:
    """List keys of the six bytes other than the pair of that number, with the number."""
    key = np.full(len(fps), number << 48, np.uint64)
    places = [p for p in range(8) if p not in _TWO[number]]
    for i, p in enumerate(places):
        key |= (fps >> np.uint64(8 * p) & np.uint64(0xFF)) << np.uint64(8 * i)
    return key.view(np.int64)


def _runs(
    batches: Iterator[pa.RecordBatch], limit: int
) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(part of a long list?, keys, fingerprints) of sorted rows, whole lists unless long."""
    keys = np.empty(0, np.int64)
    fps = np.empty(0, np.uint64)
    long_key = None
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
        if long_key is not None:
            end = int(np.searchsorted(keys, long_key, "right"))
            if end:
                yield True, keys[:end], fps[:end]
            keys, fps = keys[end:], fps[end:]
            if not len(keys):
                continue
            long_key = None
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last:
            yield False, keys[:last], fps[:last]
        keys, fps = keys[last:], fps[last:]
        if len(keys) > limit:
            long_key = keys[-1]
            yield True, keys, fps
            keys, fps = keys[:0], fps[:0]
    if len(keys):
        yield False, keys, fps


def _compare(batches: Iterator[pa.RecordBatch], limit: int, six: bool) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, key): a link (no key), or a long list's fingerprint b and its next key."""
    for long, keys, fps in _runs(batches, limit):
        if long:
            four = int(keys[0]) >> 32
            free = [48 - 16 * i + 8 * h for i in range(4) if i not in _FOUR[four] for h in (0, 1)]
            for left in combinations(free, 2):
                number = _TWO.index(tuple(sorted(p // 8 for p in left)))
                yield _rows(np.zeros(len(fps), np.int64), fps.view(np.int64), six_keys(fps, number))
            continue
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        sizes = np.diff(cuts)
        a_all, b_all = [], []
        two = cuts[:-1][sizes == 2]
        keep = linked_pairs(fps[two], fps[two + 1])
        a_all.append(fps[two[keep]])
        b_all.append(fps[two[keep] + 1])
        for lo in cuts[:-1][sizes > 2]:
            hi = int(np.searchsorted(keys, keys[lo], "right"))
            if six:
                places = tuple(8 * p for p in _TWO[int(keys[lo]) >> 48])
                a, b = six_links(fps[lo:hi], places)
            else:
                a, b = list_links(fps[lo:hi], int(keys[lo]) >> 32)
            a_all.append(a)
            b_all.append(b)
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if len(a):
            yield _rows(a.view(np.int64), b.view(np.int64), None)


def _rows(a: np.ndarray, b: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
    keys = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), keys], ["a", "b", "key"]
    )


def _lists(rows: DataFrame, limit: int, six: bool) -> DataFrame:
    """Rows of (key, fp) gathered by key and compared list by list."""
    gathered = rows.repartition("key").sortWithinPartitions("key", "fp")
    return gathered.mapInArrow(
        lambda batches: _compare(batches, limit, six), "a bigint, b bigint, key bigint"
    )


def links(nodes: DataFrame, folder: str, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``fp``, enough to connect all that link."""
    fp = F.col("fp")
    block = [F.shiftrightunsigned(fp, 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [
        F.lit(n << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j])
        for n, (i, j) in enumerate(_FOUR)
    ]
    listed = nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")
    first = stage(_lists(listed, long_list, six=False), f"{folder}/lists-of-four")
    onward = first.where("key is not null").select("key", F.col("b").alias("fp"))
    second = _lists(onward, 1 << 17, six=True)
    return first.where("key is null").unionByName(second).select("a", "b")


def components(pairs: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of every node with a link.

    Large-star and small-star rounds until nothing changes; each table is written,
    and those of the round before are removed.
    """
    spark = pairs.sparkSession
    pairs = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(pairs.where("u != v").distinct(), f"{folder}/round-0/edges")
    signature = [F.count("*"), F.bit_xor(F.xxhash64("u", "v"))]
    before, n = tuple(edges.agg(*signature).first()), 0
    while True:
        n += 1
        here = f"{folder}/round-{n}"
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        least = stage(least, f"{here}/large")
        stars = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stage(stars.distinct(), f"{here}/stars")
        least = stage(stars.groupBy("u").agg(F.min("v").alias("m")), f"{here}/small")
        moved = stars.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stage(moved, f"{here}/edges")
        after = tuple(edges.agg(*signature).first())
        remove(spark, f"{folder}/round-{n - 1}")
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """``id``, ``fp`` and ``component_id`` (smallest id reachable) of every row."""
    folder = run_folder(docs.sparkSession)
    rows = stage(fingerprints(docs, id_col, text_col, size), f"{folder}/rows")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), f"{folder}/nodes")
    found = components(links(nodes, folder, long_list), folder)
    linked = nodes.join(found, F.col("fp") == F.col("node")).select("fp", "root", "first")
    linked = stage(linked, f"{folder}/linked")
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = linked.join(stage(names, f"{folder}/names"), "root").select("fp", "component_id")
    named = nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    )
    return rows.join(stage(named, f"{folder}/named"), "fp")


def near_deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, the one with the smallest id, columns as before.

    Needs ids that tell documents apart: of rows that repeat the kept id, the one whose
    columns hash lowest stays.
    """
    groups = near_groups(docs, id_col, text_col)
    stay = groups.where(F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("i"))
    met = rows.join(stay, F.col("i").eqNullSafe(F.col("id")))
    once = Window.partitionBy("id").orderBy(F.xxhash64("doc"))
    return met.withColumn("n", F.row_number().over(once)).where("n = 1").select("doc.*")


def digest(groups: DataFrame) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), "component_id")
