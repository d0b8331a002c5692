"""Benchmark decontamination by winnowing.

Texts and benchmark items are cut into words.  Of every ``w`` consecutive k-grams of
words the smallest hash is kept (winnowing); with ``k + w - 1 = window`` any shared
run of ``window`` words holds a k-gram that both sides keep, because the kept one
depends on the run alone.  The kept hashes of the documents are joined with those of
the items, and every hit is extended to both sides: each run of ``window`` words around
it is looked up among the items' distinct windows and compared word by word.  Items shorter
than ``window`` words are one window each, found by winnowing with ``k`` = their length and
``w`` = 1.  A gram that repeats on both sides thus costs the sum of its places, not
their product.

The items are a stated query set: they are read in blocks of bounded bytes, each
block's table of kept hashes is broadcast, and the documents pass block after block
without a shuffle.  Memory is one block, one batch of documents and one part of texts per
task; a text goes to the Python workers once, inside its document.

Defined cases: null or wordless text has no words and no hits; null or wordless items
never hit; the words of an item without id hit, but it is not among the items found; equal items count
separately; a repeated document row is reported each time; an empty benchmark leaves all documents clean; other columns, whatever their
names, are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import (
    gram_hashes,
    lists,
    place_of,
    ship,
    sliding,
    span_hashes,
    spans_of,
    text_parts,
)

WINDOW = 13
GRAM = 7
BLOCK_BYTES = 16 * 1024 * 1024
PAIRS = 1 << 20  # (text, item) listed at a time
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

# Words are ASCII letters and digits and everything beyond ASCII, A-Z in lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the first word of each text (and the end)."""
    data = _LOWER[data]
    starts, ends = spans_of(_WORD[data], bounds)
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def whole_grams(words: np.ndarray, firsts: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k-gram at every word, the largest value where it would leave its text."""
    grams = np.full(len(words), _NONE)
    made = gram_hashes(words, k)
    grams[: len(made)] = np.minimum(made, _NONE - np.uint64(1))
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(len(words))
    grams[left < k] = _NONE
    return grams


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the smallest of some window of w; ties are all kept."""
    if w == 1 or len(grams) < w:
        return np.flatnonzero(grams != _NONE)
    least = sliding(grams, w, np.minimum)
    pad = np.zeros(w - 1, np.uint64)
    highest = sliding(np.concatenate([pad, least, pad]), w, np.maximum)
    return np.flatnonzero((grams != _NONE) & (grams <= highest))


class Block:
    """Winnowed fingerprints of some items: their kept hashes, and their distinct windows.

    Equal windows are one window, whatever the number of items that hold it, and equal
    lists of items are one list; so a phrase that repeats within an item or in many items
    costs a document one lookup.
    """

    def __init__(self, items: list[tuple[int | None, str]], window: int, gram: int):
        by_text: dict[bytes, list[int]] = {}
        for item, text in items:
            ids = by_text.setdefault((text or "").encode(), [])
            if item is not None:
                ids.append(item)
        texts = list(by_text)
        self.ids = [np.array(x, np.int64) for x in by_text.values()]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in texts], out=bounds[1:])
        flat = np.frombuffer(b"".join(texts), np.uint8)
        self.words, firsts = word_hashes(flat, bounds)
        lengths = np.diff(firsts)
        own = np.repeat(np.arange(len(texts)), lengths)
        groups: dict[bytes, int] = {}  # lists of several texts, as bytes
        self.tables = []
        for m in sorted({int(x) for x in lengths if 0 < x < window}) + [window]:
            k, w = (min(gram, m), m - min(gram, m) + 1) if m == window else (m, 1)
            grams = whole_grams(self.words, firsts, k)
            fits = lengths[own] >= window if m == window else lengths[own] == m
            at = winnow(grams, w)
            kept = np.unique(grams[at[fits[at]]])
            if not len(kept):
                continue
            seen = np.zeros(1 << 16, bool)
            seen[kept >> np.uint64(48)] = True
            whole = whole_grams(self.words, firsts, m) if m > k else grams
            at = np.flatnonzero(fits & (whole != _NONE))
            at = at[np.lexsort((own[at], whole[at]))]
            hashes, texts_of = whole[at], own[at]
            new = np.ones(len(at), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (texts_of[1:] != texts_of[:-1])
            at, hashes, texts_of = at[new], hashes[new], texts_of[new]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            last = np.append(first[1:], len(hashes))
            group = texts_of[first]  # a window of one text has that text's number
            for i in np.flatnonzero(last - first > 1):
                members = texts_of[first[i] : last[i]].tobytes()
                group[i] = len(texts) + groups.setdefault(members, len(groups))
            self.tables.append((m, k, w, kept, seen, hashes[first], at[first], group))
        members = [np.frombuffer(x, own.dtype) for x in groups]
        self.members = np.concatenate([np.arange(len(texts)), *members])
        sizes = [1] * len(texts) + [len(x) for x in members]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def hits(block: Block, words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hit flag of every word; pairs (text, distinct item) that share a window, distinct."""
    hit = np.zeros(len(words) + 1, np.int64)
    groups = [np.empty((0, 2), np.int64)]
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    for m, k, w, kept, seen, windows, places, group in block.tables:
        if len(words) < m:
            continue
        grams = whole_grams(words, firsts, k)
        at = winnow(grams, w)
        at = at[seen[grams[at] >> np.uint64(48)]]
        at = at[kept[np.minimum(np.searchsorted(kept, grams[at]), len(kept) - 1)] == grams[at]]
        if not len(at):
            continue
        # Extend to both sides: the windows around a kept gram, each looked up once.
        around = np.zeros(len(words) + 1, np.int64)
        np.add.at(around, np.maximum(at - (m - k), 0), 1)
        np.add.at(around, at + 1, -1)
        at = np.flatnonzero(np.cumsum(around)[:-1] > 0)
        whole = whole_grams(words, firsts, m) if m > k else grams
        at = at[whole[at] != _NONE]
        of = np.minimum(np.searchsorted(windows, whole[at]), len(windows) - 1)
        same = windows[of] == whole[at]
        at, of = at[same], of[same]
        for i in range(m):
            same = words[at + i] == block.words[places[of] + i]
            if not same.all():
                at, of = at[same], of[same]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + m, -1)
        groups.append(np.unique(np.stack([owner[at], group[of]], axis=1), axis=0))
    found = np.unique(np.concatenate(groups), axis=0)
    n = block.starts[found[:, 1] + 1] - block.starts[found[:, 1]]
    total = np.concatenate([[0], np.cumsum(n)])
    pairs = np.empty((0, 2), np.int64)
    for start in range(0, int(total[-1]), PAIRS):
        pair = np.arange(start, min(start + PAIRS, int(total[-1])))
        of = np.searchsorted(total, pair, "right") - 1
        item = block.members[block.starts[found[of, 1]] + pair - total[of]]
        pairs = np.unique(np.concatenate([pairs, np.stack([found[of, 0], item], axis=1)]), axis=0)
    return np.cumsum(hit)[:-1] > 0, pairs


def _scan(batches: Iterator[pa.RecordBatch], shared, held: int | None) -> Iterator[pa.RecordBatch]:
    """Adds the hits of one block to those of the blocks before; the text is field ``held`` of ``doc``, if any."""
    block = shared.value
    for batch in batches:
        texts = batch.column("text") if held is None else batch.column("doc").field(held)
        for lo, hi, data, bounds in text_parts(texts):
            words, firsts = word_hashes(data, bounds)
            hit, found = hits(block, words, firsts)
            before = batch.slice(lo, hi - lo)
            spans = before.column("spans")
            if len(spans.flatten()):
                rows = np.repeat(np.arange(hi - lo), np.diff(spans.offsets))
                flat = spans.flatten()
                start = firsts[rows] + flat.field("start").to_numpy()
                stop = firsts[rows] + flat.field("end").to_numpy()
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, start, 1)
                np.add.at(marks, stop, -1)
                hit |= np.cumsum(marks)[:-1] > 0
            starts, ends = spans_of(hit, firsts)
            n_spans = np.diff(np.searchsorted(starts, firsts))
            base = np.repeat(firsts[:-1], n_spans)
            flat = pa.StructArray.from_arrays(
                [pa.array(starts - base, pa.int32()), pa.array(ends - base, pa.int32())],
                ["start", "end"],
            )
            many = np.array([len(block.ids[i]) for i in found[:, 1]], np.int64)
            ids = [block.ids[i] for i in found[:, 1]] or [np.empty(0, np.int64)]
            n_items = np.bincount(np.repeat(found[:, 0], many), minlength=hi - lo)
            items = lists(pa.array(np.concatenate(ids)), n_items)
            if len(before.column("items").flatten()):
                both = zip(before.column("items").to_pylist(), items.to_pylist(), strict=True)
                items = pa.array([a + b for a, b in both], pa.list_(pa.int64()))
            made = {"n_words": pa.array(np.diff(firsts), pa.int64()), "spans": lists(flat, n_spans), "items": items}
            kept = [name for name in batch.schema.names if name not in made]
            yield pa.RecordBatch.from_arrays([*map(before.column, kept), *made.values()], [*kept, *made])


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about BLOCK_BYTES, each collected on its own."""
    size = F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))
    n = items.agg(size.alias("n")).first()["n"] // BLOCK_BYTES + 1
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64(item_col, text_col), F.lit(n)) == i)
        rows = part.select(F.col(item_col).cast("bigint"), F.col(text_col)).collect()
        yield [(row[0], row[1]) for row in rows]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    max_share: int = 20,
) -> DataFrame:
    """One row per document row: ``doc`` (all its columns as a struct) and what was found.

    ``n_words``; ``spans`` (start, end: word numbers of maximal hit runs); ``items``
    (ids of items with a shared window, ascending); ``n_hit``; ``contaminated``: at
    least one in ``max_share`` words is hit.  Collecting the blocks of items runs one
    small job each.
    """
    spark = docs.sparkSession
    ship(spark)
    held = place_of(docs, text_col)
    rows = docs.select(
        F.struct("*").alias("doc"),
        *([F.col(text_col).cast("string").alias("text")] if held is None else []),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"),
        F.expr("cast(array() as array<bigint>)").alias("items"),
    )
    schema = rows.schema
    for block in _blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Block(block, window, gram))
        rows = rows.mapInArrow(lambda it, shared=shared: _scan(it, shared, held), schema)
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]).cast("bigint")
    )
    rows = rows.select(
        "doc", "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"), n_hit.alias("n_hit")
    )
    dirty = (F.col("n_hit") > 0) & (F.lit(max_share) * F.col("n_hit") >= F.col("n_words"))
    return rows.withColumn("contaminated", dirty)


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    found = contamination(docs, items, **options)
    return found.where(~F.col("contaminated")).select("doc.*")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One summary row per document row."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        F.col("doc")[id_col].alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )
