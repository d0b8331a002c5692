"""Removal of repeated byte strings with suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id; strings are judged on the input.

1. Documents are dealt into shards by a hash of their id.  Every string of LENGTH bytes
   (a window) names an anchor, the smallest hash among its 16-byte grams, so equal
   windows name equal anchors wherever they occur; windows that share an anchor follow
   one another and form a piece.
2. The shards send the hashes of their anchors, each once, to buckets by range; a
   bucket answers which of them more than one document has.  Nothing else can repeat.
3. Pieces of such anchors go to the bucket of their anchor, equal pieces of a shard
   once, with the smallest id that has them.  There a suffix array of the distinct
   pieces is built by Larsson-Sadakane refinement, Kasai's common prefixes cut it into
   groups of equal windows, and every group takes its smallest id.  A bucket of more
   than ``POSITIONS`` suffixes is cut into shards with an array each, whose groups are
   merged by binary search of their windows in one another.
4. The answer, the smallest id along each piece, returns to the shards that asked, and
   these remove the windows of larger ids.

Texts are shuffled once (the three visits to the shards share the exchange), hashes
once, and only pieces that may repeat are sent.  A passage that a third of all
documents share costs a bucket one piece per shard, except where it begins and ends.
Memory is one shard or one part of a bucket.

Defined cases: a null text is empty; texts under LENGTH bytes keep everything; a null
id counts as larger than all others; rows that repeat an id do not remove each other
but both yield to smaller ids; an empty table gives an empty result; cuts may fall
inside a character, so kept bytes are binary; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.shared import _power_tables, lists, mixed, ship, spans_of, text_parts
from shelflife.llm.suffix import common_prefixes, suffix_array

LENGTH = 50
GRAM = 16
SHARD_BYTES = 4 * 1024 * 1024
BUCKETS = 2  # per shard
POSITIONS = 1 << 19
_NO_ID = np.iinfo(np.int64).max


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash) of the anchors of some texts, in order."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    forth, back = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[: len(data)], out=total[1:])
    grams = mixed((total[GRAM:] - total[:-GRAM]) * back[: len(data) - GRAM + 1])
    # The smallest hash of each window and where it is, the last of several.
    least = (grams >> np.uint64(32)).astype(np.uint32)
    at = np.arange(len(grams), dtype=np.int32)
    have, width = 1, LENGTH - GRAM + 1
    while have < width:
        step = min(have, width - have)
        later = least[step:] <= least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        have += step
    fits = np.ones(n, bool)
    for end in bounds[1:-1]:
        fits[max(end - LENGTH + 1, 0) : end] = False
    new = fits.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~fits[:-1]
    last = fits.copy()
    last[:-1] &= (at[1:] != at[:-1]) | ~fits[1:]
    first = np.flatnonzero(new)
    # The smallest of many hashes is a small number: mixed again, they fill the buckets alike.
    return first, np.flatnonzero(last), mixed(~grams[at[first]])


class Shard:
    """The texts of a shard with their anchors; positions are bytes of ``flat``."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        column = table.column("text")
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        ids = table.column("id").to_numpy(zero_copy_only=False)
        self.null = np.array([x is None or x != x for x in ids], bool)
        self.ids = np.array([_NO_ID if no else int(x) for x, no in zip(ids, self.null, strict=True)], np.int64)
        parts, firsts, lasts, hashes, at, bounds = [], [], [], [], 0, [np.zeros(1, np.int64)]
        for _, _, data, inner in text_parts(column):
            first, last, found = anchors(data, inner)
            parts.append(data)
            firsts.append(first + at)
            lasts.append(last + at)
            hashes.append(found)
            bounds.append(inner[1:] + at)
            at += len(data)
        self.flat = np.concatenate(parts) if parts else np.empty(0, np.uint8)
        self.bounds = np.concatenate(bounds)
        self.first = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
        self.last = np.concatenate(lasts) if lasts else np.empty(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.doc = np.searchsorted(self.bounds, self.first, "right") - 1

    def anchor_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and whether several documents here have them."""
        order = np.lexsort((self.doc, self.hash))
        h, d = self.hash[order], self.doc[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        number = np.cumsum(new) - 1
        several = np.zeros(int(new.sum()), bool)
        several[number[1:][~new[1:] & (d[1:] != d[:-1])]] = True
        return h[new], several

    def pieces(self, shared: np.ndarray) -> Pieces:
        """The pieces whose anchor hash is one of the (sorted) shared ones, equal ones once."""
        at = np.searchsorted(shared, self.hash)
        at[at == len(shared)] = 0
        kept = np.flatnonzero(shared[at] == self.hash) if len(shared) else np.empty(0, np.int64)
        first, stop = self.first[kept], self.last[kept] + LENGTH
        key = piece_hashes(self.flat, first, stop)
        doc = self.ids[self.doc[kept]]
        order = np.lexsort((doc, key, self.hash[kept]))
        new = np.ones(len(order), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        chosen = kept[order[new]]
        return Pieces(kept, number, chosen, self.hash[chosen], self.ids[self.doc[chosen]])


class Pieces:
    def __init__(self, members, number, chosen, hashes, least):
        self.members = members  # anchors, as numbers of the shard's
        self.number = number  # of each member: its distinct piece
        self.chosen = chosen  # of each distinct piece: an anchor that has it
        self.hashes = hashes  # of its anchor; ascending
        self.least = least  # the smallest id here


def piece_hashes(flat: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each byte span, lengths included."""
    if not len(first):
        return np.empty(0, np.uint64)
    cut = np.uint64(0x9E3779B97F4A7C15)
    out = np.empty(len(first), np.uint64)
    # Power tables stay small when long shards are read in steps; spans are short.
    width = 1 << 19
    lo = 0
    while lo < len(first):
        hi = max(int(np.searchsorted(first, first[lo] + width, "left")), lo + 1)
        base, end = int(first[lo]), int(stop[lo:hi].max())
        data = flat[base:end]
        forth, back = _power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[: len(data)], out=total[1:])
        a, b = first[lo:hi] - base, stop[lo:hi] - base
        out[lo:hi] = mixed((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64) * cut)
        lo = hi
    return out


def bucket_cuts(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of n ranges of the hash space begins in the sorted hashes, and the end."""
    edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


_SENT = pa.schema(
    [("bucket", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())]
)
_SENT_SQL = "bucket bigint, shard bigint, n bigint, a binary, b binary, c binary"


def send_hashes(table: pa.Table, n_buckets: int) -> pa.Table:
    """Step 2, from a shard: per bucket the hashes (a) and which several documents have (b)."""
    shard = table.column("shard")[0].as_py()
    hashes, several = Shard(table).anchor_hashes()
    cuts = bucket_cuts(hashes, n_buckets)
    rows = [
        (k, shard, int(hi - lo), hashes[lo:hi].tobytes(), np.packbits(several[lo:hi]).tobytes(), b"")
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))
        if hi > lo
    ]
    return _table(rows, _SENT)


def answer_hashes(table: pa.Table) -> pa.Table:
    """Step 2, from a bucket: per shard which of its hashes several documents have (a)."""
    rows = table.to_pylist()
    hashes = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in rows])
    several = np.concatenate(
        [np.unpackbits(np.frombuffer(r["b"], np.uint8), count=r["n"]) for r in rows]
    )
    values, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[number[several == 1]] = True
    out, at = [], 0
    for r in rows:
        flags = shared[number[at : at + r["n"]]]
        at += r["n"]
        out.append((r["bucket"], r["shard"], r["n"], np.packbits(flags).tobytes(), b"", None))
    return _table(out, _SENT)


def _shared(shard: Shard, answers: list[dict], n_buckets: int) -> np.ndarray:
    """The shard's hashes that the answers mark, ascending."""
    hashes, _ = shard.anchor_hashes()
    cuts = bucket_cuts(hashes, n_buckets)
    keep = np.zeros(len(hashes), bool)
    for r in answers:
        lo, hi = cuts[r["bucket"]], cuts[r["bucket"] + 1]
        keep[lo:hi] = np.unpackbits(np.frombuffer(r["a"], np.uint8), count=r["n"])
    return hashes[keep]


def send_pieces(texts: pa.Table, answers: pa.Table, n_buckets: int) -> pa.Table:
    """Step 3, from a shard: per bucket lengths (a), smallest ids (b) and bytes (c) of pieces."""
    if not texts.num_rows:
        return _table([], _SENT)
    number = texts.column("shard")[0].as_py()
    shard = Shard(texts)
    pieces = shard.pieces(_shared(shard, answers.to_pylist(), n_buckets))
    first, stop = shard.first[pieces.chosen], shard.last[pieces.chosen] + LENGTH
    cuts = bucket_cuts(pieces.hashes, n_buckets)
    rows = []
    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if hi > lo:
            size = stop[lo:hi] - first[lo:hi]
            flat = shard.flat[np.repeat(first[lo:hi] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
            rows.append((k, number, int(hi - lo), size.astype(np.uint8).tobytes(), pieces.least[lo:hi].tobytes(), flat.tobytes()))
    return _table(rows, _SENT)


def least_ids(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every position that begins a window, the smallest id of a piece with that window."""
    out = np.full(len(flat), _NO_ID)
    shards = []
    lo = 0
    while lo < len(starts):
        hi = max(int(np.searchsorted(stops, starts[lo] + POSITIONS, "right")), lo + 1)
        base = starts[lo]
        text = flat[base : stops[hi - 1]]
        a, b = starts[lo:hi] - base, stops[lo:hi] - base
        ends = np.repeat(b, b - a)
        order = suffix_array(text, ends)
        shared = common_prefixes(text, a, b, order, least=LENGTH)
        new = shared < LENGTH
        new[:1] = True
        own = np.repeat(ids[lo:hi], b - a)[order]
        least = np.minimum.reduceat(own, np.flatnonzero(new))
        group = np.cumsum(new) - 1
        shards.append((base, text, order, group, least, np.flatnonzero(new), ends))
        lo = hi
    if len(shards) > 1:
        merge(shards)
    for base, _, order, group, least, _, _ in shards:
        out[base + order] = least[group]
    return out


def merge(shards: list[tuple]) -> None:
    """Give the groups of equal windows in different arrays their common smallest id."""
    windows = []
    for _, text, order, _, _, heads, ends in shards:
        at = order[heads]
        whole = np.flatnonzero(ends[at] - at >= LENGTH)
        # A last byte of one keeps zero bytes at a window's end from being cut off.
        rows = np.ones((len(whole), LENGTH + 1), np.uint8)
        rows[:, :LENGTH] = text[at[whole][:, None] + np.arange(LENGTH)]
        windows.append((whole, rows.view(f"S{LENGTH + 1}").ravel()))
    for x in range(len(shards)):
        for y in range(x + 1, len(shards)):
            (whole, mine), (other_whole, others) = windows[x], windows[y]
            if not len(mine) or not len(others):
                continue
            at = np.searchsorted(others, mine)
            at[at == len(others)] = 0
            met = np.flatnonzero(others[at] == mine)
            p, q = whole[met], other_whole[at[met]]
            both = np.minimum(shards[x][4][p], shards[y][4][q])
            shards[x][4][p] = both
            shards[y][4][q] = both


def answer_pieces(table: pa.Table) -> pa.Table:
    """Step 4, from a bucket: per piece of a shard the number of runs (a) of windows with one
    smallest id, and each run's first window (b) and id (c); none where that is the shard's."""
    rows = table.to_pylist()
    size = np.concatenate([np.frombuffer(r["a"], np.uint8) for r in rows]).astype(np.int64)
    ids = np.concatenate([np.frombuffer(r["b"], np.int64) for r in rows])
    flat = np.frombuffer(b"".join(r["c"] for r in rows), np.uint8)
    stops = np.cumsum(size)
    starts = stops - size
    # Equal pieces of several shards go into the array once.
    key = piece_hashes(flat, starts, stops)
    _, one, number = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(one), _NO_ID)
    np.minimum.at(least, number, ids)
    length = size[one]
    inner = np.concatenate([[0], np.cumsum(length)])
    text = flat[np.repeat(starts[one] - inner[:-1], length) + np.arange(int(length.sum()))]
    found = least_ids(text, inner[:-1], inner[1:], least)
    windows = length - LENGTH + 1
    owner = np.repeat(np.arange(len(one)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    value = found[inner[:-1][owner] + offset]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    run_owner, run_offset, run_value = owner[new], offset[new], value[new]
    run_count = np.bincount(run_owner, minlength=len(one))
    run_first = np.cumsum(run_count) - run_count
    plain = run_count[number] == 1
    plain[plain] = run_value[run_first[number[plain]]] == ids[plain]
    counts = np.where(plain, 0, run_count[number])
    out, at = [], 0
    for r in rows:
        n = counts[at : at + r["n"]]
        which = np.repeat(run_first[number[at : at + r["n"]]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at += r["n"]
        out.append(
            (r["bucket"], r["shard"], r["n"], n.astype(np.uint8).tobytes(),
             run_offset[which].astype(np.uint8).tobytes(), run_value[which].tobytes())
        )
    return _table(out, _SENT)


def removed(shard: Shard, pieces: Pieces, answers: list[dict], n_buckets: int) -> np.ndarray:
    """Flag of every byte of the shard that a smaller id repeats."""
    cuts = bucket_cuts(pieces.hashes, n_buckets)
    n = len(pieces.chosen)
    counts = np.zeros(n, np.int64)
    offsets, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for r in sorted(answers, key=lambda r: r["bucket"]):
        counts[cuts[r["bucket"]] : cuts[r["bucket"] + 1]] = np.frombuffer(r["a"], np.uint8)
        offsets.append(np.frombuffer(r["b"], np.uint8).astype(np.int64))
        values.append(np.frombuffer(r["c"], np.int64))
    # A piece without runs has one, over all its windows, with the smallest id here.
    length = shard.last[pieces.chosen] - shard.first[pieces.chosen] + 1
    owner = np.repeat(np.arange(n), np.maximum(counts, 1))
    offset = np.zeros(len(owner), np.int64)
    value = pieces.least[owner]
    told = counts[owner] > 0
    offset[told], value[told] = np.concatenate(offsets), np.concatenate(values)
    stop = length[owner]
    same = np.flatnonzero(owner[1:] == owner[:-1])
    stop[same] = offset[same + 1]
    runs = np.maximum(counts, 1)
    run_first = np.cumsum(runs) - runs
    m = runs[pieces.number]
    member = np.repeat(np.arange(len(m)), m)
    run = np.repeat(run_first[pieces.number] - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
    anchor = pieces.members[member]
    later = value[run] < shard.ids[shard.doc[anchor]]
    anchor, run = anchor[later], run[later]
    marks = np.zeros(len(shard.flat) + 1, np.int32)
    np.add.at(marks, shard.first[anchor] + offset[run], 1)
    np.add.at(marks, shard.first[anchor] + stop[run] - 1 + LENGTH, -1)
    return np.cumsum(marks)[:-1] > 0


_RESULT = (
    "id bigint, n_bytes bigint, n_removed bigint, "
    "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept binary"
)


def results(texts: pa.Table, answers: pa.Table, n_buckets: int, with_kept: bool) -> pa.Table:
    """Step 4, from a shard: what is removed from and kept of each document."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), spans_type, pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    if not texts.num_rows:
        return _table([], schema)
    shard = Shard(texts)
    rows = answers.to_pylist()
    marked = [r for r in rows if r["c"] is None]
    pieces = shard.pieces(_shared(shard, marked, n_buckets))
    gone = removed(shard, pieces, [r for r in rows if r["c"] is not None], n_buckets)
    starts, stops = spans_of(gone, shard.bounds)
    of = np.searchsorted(shard.bounds, starts, "right") - 1
    counts = np.bincount(of, minlength=len(shard.ids))
    flat = pa.StructArray.from_arrays(
        [pa.array(starts - shard.bounds[of]), pa.array(stops - shard.bounds[of])],
        fields=list(spans_type.value_type),
    )
    before = np.concatenate([[0], np.cumsum(gone)])[shard.bounds]
    kept = shard.flat[~gone].tobytes()
    cuts = (shard.bounds - before).tolist()
    kept_texts = [kept[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.table(
        [
            pa.array(shard.ids, pa.int64(), mask=shard.null),
            pa.array(np.diff(shard.bounds)),
            pa.array(np.diff(before)),
            lists(flat, counts),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept_texts]),
            pa.array(kept_texts if with_kept else [None] * len(kept_texts), pa.binary()),
        ],
        schema=schema,
    )


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    with_kept: bool = True,
) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``spans`` (byte runs removed), ``kept_sha256``, ``kept``.

    One row per document row.  Summing the text sizes runs a job.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = total // shard_bytes + 1
    texts = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n))).groupBy("shard")
    n *= BUCKETS
    hashes = texts.applyInArrow(lambda t: send_hashes(t, n), _SENT_SQL)
    marked = hashes.groupBy("bucket").applyInArrow(answer_hashes, _SENT_SQL)
    pieces = texts.cogroup(marked.groupBy("shard")).applyInArrow(
        lambda t, m: send_pieces(t, m, n), _SENT_SQL
    )
    found = pieces.groupBy("bucket").applyInArrow(answer_pieces, _SENT_SQL)
    both = marked.unionByName(found).groupBy("shard")
    return texts.cogroup(both).applyInArrow(lambda t, m: results(t, m, n, with_kept), _RESULT)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )
