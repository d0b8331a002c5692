"""Near copies: the groups of the SimHash operator, joined with links by word shingles.

Fingerprints that differ in two bits are near certain copies, but an edited word or two
already changes more bits than that.  The groups of :mod:`shelflife.llm.simhash` are
therefore extended by links between texts whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more; components over both kinds of links are the groups.

Candidates come from signatures: of ``LISTS * WIDTH`` random orders of all shingles each
text's first one.  Two texts agree in one of them as often as their similarity says, so
runs of ``WIDTH`` agree in at least one of ``LISTS`` places for 98 in 100 pairs at 0.8 and
for more above.  Texts that agree on a run meet in its list.  In a list every text tallies
the positional bytes that it shares with the texts leading it, and is linked to the one
with the most, if these are ``SHARED`` or more; below ``EQUAL`` it leads as well.  So a list
of copies leaves one candidate per member, whatever its length.  Candidates are checked
against the whole texts.  Then the components of all links so far are looked up in the lists:
where a list holds several, the members of different ones that share ``SHARED`` or more are
checked as well, all of them.  So every pair that meets in a list ends in one component if it
is similar enough, whoever leads.

Lists are reduced to their leading texts within the tasks that made them, then shuffled by
key and reduced again: a list with a third of all rows sends a few rows per task.  Only
lists of more than one text carry signatures at all; their number is counted with partial
sums, and hot keys are left to the adaptive join.  Texts are shuffled only for candidates,
and at the end only rows that go or whose id repeats: a broadcast bitmap of hashes leaves all
others where they are.

Defined cases: words and letters' case as in the SimHash operator; fewer words than a
shingle make one shingle; texts without words are linked by their fingerprint alone;
repeated ids are one node, and of rows that repeat the kept id the one whose columns hash
lowest stays; a null id is a node of its own; an empty table gives an empty result; other
columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflife.llm import simhash
from shelflife.llm.shared import (
    gram_hashes,
    mixed,
    run_folder,
    ship,
    span_hashes,
    spans_of,
    stage,
    text_parts,
)
from shelflife.operators.joins import some_of

SHINGLE = 5
SIMILARITY = 0.8
LISTS, WIDTH = 8, 4
ORDERS = 128  # of them the first LISTS * WIDTH make lists; one byte of each is tallied
SHARED = 88  # of ORDERS: a pair at 0.8 shares 102, give or take 5
EQUAL = 118  # of ORDERS: what is similar to one of such a pair is similar to the other
WEAK = 4_096

# Words are everything but white space, A-Z in lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_FACTORS = np.random.default_rng(5).integers(1 << 62, size=ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of many texts, text after text, and where each text's begin."""
    data = _LOWER[data]
    starts, ends = spans_of(_WORD[data], bounds)
    words = span_hashes(data, starts, ends)
    firsts = np.searchsorted(starts, bounds)
    counts = np.diff(firsts)
    left = np.repeat(firsts[1:], counts) - np.arange(len(words))
    made = np.zeros(len(words), np.uint64)
    grams = gram_hashes(words, size)
    made[: len(grams)] = grams
    for n in range(1, size):  # texts of fewer words
        for i in np.flatnonzero(counts == n):
            made[firsts[i]] = gram_hashes(words[firsts[i] : firsts[i + 1]], n)[0]
    own = np.repeat(counts, counts)
    kept = (left >= size) | ((own < size) & (left == own))
    return made[kept], np.concatenate([[0], np.cumsum(kept)])[firsts]


def signatures(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text with shingles: the keys of its lists, and a byte of its first in each order."""
    heads = firsts[:-1][firsts[:-1] < firsts[1:]]
    least = np.empty((ORDERS, len(heads)), np.uint64)
    for i, factor in enumerate(_FACTORS):
        value = hashes * factor
        value ^= value >> np.uint64(29)
        least[i] = np.minimum.reduceat(value, heads) if len(heads) else 0
    keys = np.empty((len(heads), LISTS), np.uint64)
    for i in range(LISTS):
        key = np.full(len(heads), i + 1, np.uint64)
        for row in least[i * WIDTH : (i + 1) * WIDTH]:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[:, i] = key
    return keys.view(np.int64), (mixed(least) >> np.uint64(56)).astype(np.uint8).T


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in text_parts(batch.column("text")):
            hashes, firsts = shingles(data, bounds, size)
            keys, marks = signatures(hashes, firsts)
            some = np.flatnonzero(firsts[:-1] < firsts[1:])
            flat = pa.array(np.ascontiguousarray(keys).ravel())
            offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * LISTS)
            raw = pa.py_buffer(np.ascontiguousarray(marks).tobytes())
            bytes_at = pa.py_buffer((np.arange(len(some) + 1, dtype=np.int32) * ORDERS).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").slice(lo, hi - lo).take(pa.array(some)),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.Array.from_buffers(pa.binary(), len(some), [None, bytes_at, raw]),
                ],
                ["node", "keys", "marks"],
            )


class Leaders:
    """The leading texts of one list.

    Those that share too little with all before them lead, and so do those that are not
    nearly equal to one of them, as what is similar to them need not be to their leader.
    Of the latter at most ``weak`` are held, the newest; a list of more is one whose texts
    nearly all differ from its leaders by an edit.  :func:`across` compares what that leaves out.
    """

    def __init__(self, weak: int = WEAK) -> None:
        self.strict, self.weak, self.most = _Held(), _Held(), weak

    def meet(self, node: int, marks: np.ndarray) -> tuple[int | None, bool]:
        """The leading text that shares most with this one, if enough, and whether this one leads."""
        tally, leader = max(self.strict.best(marks), self.weak.best(marks))
        if tally < SHARED:
            self.strict.add(node, marks)
            return None, True
        if tally < EQUAL:
            self.weak.add(node, marks, self.most)
        return leader, tally < EQUAL


class _Held:
    def __init__(self) -> None:
        self.nodes = np.empty(4, np.int64)
        self.marks = np.empty((4, ORDERS), np.uint8)
        self.n = 0

    def best(self, marks: np.ndarray) -> tuple[int, int]:
        if not self.n:
            return -1, 0
        tally = (self.marks[: self.n] == marks).sum(axis=1)
        i = int(tally.argmax())
        return int(tally[i]), int(self.nodes[i])

    def add(self, node: int, marks: np.ndarray, most: int = 0) -> None:
        if most and self.n == most:
            self.n = most // 2
            self.nodes[: self.n] = self.nodes[most - self.n : most].copy()
            self.marks[: self.n] = self.marks[most - self.n : most].copy()
        if self.n == len(self.nodes):
            self.nodes = np.concatenate([self.nodes, self.nodes])
            self.marks = np.concatenate([self.marks, self.marks])
        self.nodes[self.n], self.marks[self.n] = node, marks
        self.n += 1


def _lead(batches: Iterator[pa.RecordBatch], weak: int = WEAK) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, marks) in order of key, with ``leader``, if any, and whether they lead."""
    leaders, last = Leaders(weak), None
    for batch in batches:
        keys = batch.column("key").to_numpy()
        nodes = batch.column("node").to_numpy()
        marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.uint8).reshape(-1, ORDERS)
        found: list[tuple[int | None, bool]] = []
        for key, node, own in zip(keys.tolist(), nodes.tolist(), marks, strict=True):
            if key != last:
                leaders, last = Leaders(weak), key
            found.append(leaders.meet(node, own))
        leader, leads = list(zip(*found, strict=True)) or ([], [])
        made = pa.array(leader, pa.int64()), pa.array(leads, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("node"), batch.column("marks"), *made],
            ["key", "node", "marks", "leader", "leads"],
        )


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sets of shingles (distinct, sorted) are as similar as that."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _check(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for name in ("text", "other"):
            sets: list[np.ndarray] = []
            for _, _, data, bounds in text_parts(batch.column(name)):
                hashes, firsts = shingles(data, bounds, size)
                sets += [np.unique(hashes[x:y]) for x, y in zip(firsts, firsts[1:], strict=False)]
            sides.append(sets)
        keep = np.array([similar(a, b, similarity) for a, b in zip(*sides, strict=True)], bool)
        kept = batch.select(["a", "b"]).filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays(kept.columns, ["a", "b"])


def listed(texts: DataFrame, folder: str, size: int = SHINGLE) -> DataFrame:
    """``key``, ``node`` and ``marks``: the members of the lists of more than one text."""
    of_node = texts.schema["node"].dataType.simpleString()
    made = f"node {of_node}, keys array<bigint>, marks binary"
    signed = stage(texts.mapInArrow(lambda rows: _sign(rows, size), made), f"{folder}/signed")
    keyed = signed.select("node", F.explode("keys").alias("key"))
    lists = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), f"{folder}/keys")
    met = keyed.join(lists, "key").groupBy("node").agg(F.collect_set("key").alias("met"))
    rows = signed.select("node", "marks").join(met, "node")
    return stage(rows.select(F.explode("met").alias("key"), "node", "marks"), f"{folder}/listed")


def candidates(rows: DataFrame, folder: str, weak: int = WEAK) -> DataFrame:
    """``a`` and ``b``: members of :func:`listed` lists and the leader they share most with."""
    kind = "key bigint, node bigint, marks binary, leader bigint, leads boolean"
    # Each list in an order of its own, so others lead.
    order = ["key", F.xxhash64("key", "node"), "node"]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _lead(batches, weak)

    first = stage(rows.sortWithinPartitions(*order).mapInArrow(lead, kind), f"{folder}/within-tasks")
    rest = first.where("leads").select("key", "node", "marks")
    second = rest.repartition("key").sortWithinPartitions(*order).mapInArrow(lead, kind)
    pairs = first.unionByName(second).where("leader is not null and leader != node")
    return pairs.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, ORDERS)
            for c in ("marks", "other")
        )
        keep = pa.array((a == b).sum(axis=1) >= SHARED)
        kept = batch.select(["a", "b"]).filter(keep)
        yield pa.RecordBatch.from_arrays(kept.columns, ["a", "b"])


def across(rows: DataFrame, found: DataFrame, tried: DataFrame, folder: str) -> DataFrame:
    """``a`` and ``b``: all members of one list that share enough but are not in one component yet.

    ``found`` names the components of the links so far, ``tried`` holds the pairs that were checked for
    them.  What a list's leaders left out, for whatever reason, is met here: members outside a list's
    most frequent component are compared with all others of the list.  Lists of one component, as those
    of copies are, drop out before signatures move.
    """
    members = rows.select("key", "node").distinct().join(found, "node", "left")
    members = members.select("key", "node", F.coalesce("root", "node").alias("root"))
    members = stage(members, f"{folder}/members")
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("k"))
    split = stage(mains.where("k > 1").select("key", "main"), f"{folder}/split")
    met = members.join(split, "key")
    # The distinct signatures of a member, which are several only where an id repeats.
    signed = rows.join(split.select("key"), "key", "left_semi").distinct()
    met = stage(signed.join(met, ["key", "node"]), f"{folder}/split-members")
    odd = met.where("root != main").select("key", F.col("node").alias("a"), F.col("root").alias("own"), "marks")
    all_of = met.select(
        F.col("key").alias("in"), F.col("node").alias("b"), F.col("root").alias("theirs"), "main",
        F.col("marks").alias("other"),
    )
    once = (F.col("theirs") == F.col("main")) | (F.col("own") < F.col("theirs"))
    meet = (F.col("key") == F.col("in")) & (F.col("own") != F.col("theirs")) & once
    pairs = odd.join(all_of, meet).select("a", "b", "marks", "other")
    near = pairs.mapInArrow(_tallied, "a bigint, b bigint").distinct()
    known = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return near.join(known, ["a", "b"], "left_anti")


def checked(
    pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """The pairs whose texts (``node`` bigint, ``text``) are as similar as that by shingles.

    Pairs should be a stored table.  Of the texts only those of pairs move, but for a few others.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    needed = some_of(texts, "node", nodes).where("_maybe")
    first = needed.select(F.col("node").alias("a"), "text")
    other = needed.select(F.col("node").alias("b"), F.col("text").alias("other"))
    both = pairs.join(first, "a").join(other, "b").select("a", "b", "text", "other")
    return both.mapInArrow(lambda rows: _check(rows, size, similarity), "a bigint, b bigint")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    weak: int = WEAK,
) -> DataFrame:
    """``id``, ``node`` (a hash of it) and ``component_id``, the smallest id reachable, of every id."""
    folder = run_folder(docs.sparkSession)
    node = F.xxhash64("id")
    prints = simhash.near_groups(docs, id_col, text_col).select("id", "component_id").distinct()
    prints = stage(prints, f"{folder}/prints")
    ids = prints.select("id").distinct().withColumn("node", node)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select(node.alias("node"), "text")
    # Rows that repeat an id are one node: their links are those of any of them.
    by_print = prints.where(~F.col("id").eqNullSafe(F.col("component_id")))
    by_print = by_print.select(node.alias("a"), F.xxhash64("component_id").alias("b"))
    ship(docs.sparkSession)
    rows = listed(texts, f"{folder}/shingles", size)
    pairs = stage(candidates(rows, f"{folder}/shingles", weak), f"{folder}/candidates")
    links = stage(checked(pairs, texts, size, similarity), f"{folder}/links").unionByName(by_print)
    found = stage(simhash.components(links, f"{folder}/components"), f"{folder}/found")
    more = stage(across(rows, found, pairs, f"{folder}/across"), f"{folder}/more")
    if not more.isEmpty():
        late = stage(checked(more, texts, size, similarity), f"{folder}/late")
        if not late.isEmpty():
            found = simhash.components(links.unionByName(late), f"{folder}/all-components")
    linked = stage(ids.join(found, "node").select("id", "node", "root"), f"{folder}/linked")
    names = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = linked.join(names, "root").select("node", "component_id")
    rows = ids.join(linked, "node", "left")
    return rows.select("id", "node", F.coalesce("component_id", "id").alias("component_id"))


def near_deduped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float
) -> DataFrame:
    """One document of each group stays, the one with the smallest id, columns as before."""
    folder = run_folder(docs.sparkSession)
    groups = near_groups(docs, id_col, text_col, **options).select("id", "component_id")
    groups = stage(groups, f"{folder}/groups")
    gone = groups.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("i"), F.xxhash64(id_col).alias("node"))
    again = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    # Rows to drop and ids that repeat are few: only they, and a few others, move.
    held = stage(gone.select(F.xxhash64("id").alias("node")).unionByName(again), f"{folder}/held")
    rows = some_of(rows, "node", held)
    stay = rows.where("_maybe").join(gone, F.col("i").eqNullSafe(F.col("id")), "left_anti")
    once = Window.partitionBy("i").orderBy(F.xxhash64("doc"))
    stay = stay.withColumn("n", F.row_number().over(once)).where("n = 1")
    return rows.where("not _maybe").select("doc.*").unionByName(stay.select("doc.*"))
