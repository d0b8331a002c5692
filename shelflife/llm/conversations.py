"""Repair of conversation structure: the cheapest edits, least among equals, by path ranking.

A conversation's rows, in order of turn, are made to follow ``(s?(ua)+)?`` (an optional
system row, then user and assistant in turns, or nothing) by edits: Keep 0, Rerole to user
or assistant 2, Delete 3, Insert an empty user or assistant row 2.  Blank rows and rows seen
before must be deleted; a truncated row that stays adds 1.  The audit is the initials of
the edits in order; of the cheapest audits the least in ASCII order is taken.

1. Rows that are equal, turn included, are counted as one item before anything is
   shuffled.  Items carry a hash of role and text instead of both.
2. Items are range-sorted by conversation, turn and hash, and cut into blocks of at most
   ``BLOCK``, so a conversation of any length is spread over tasks.  Each block gives the
   cost from each of four states at its start to each at its end; a stream over these
   matrices, from the last block back, gives the cost from every block's end to the end of
   the conversation.
3. Within a block, the cost at every node (row, state) tells the arcs that lie on a
   cheapest path.  They are ranked by the audits that begin with them, of length 1, 2, 4
   and so on, each round joining the rank of an arc with that of the best arc where its
   audit of the round before ends.  The final ranks pick one arc a node; pointers doubled
   over them read off the path.
4. A stream over the blocks' exit states, forward, tells the state in which each block is
   entered, and with it its audit.  The edits meet the rows again by sorting, not joining.

Texts are shuffled once.  The two streams see one small row per block, so a conversation
with a third of all rows costs its task a row per ``BLOCK`` items; the last stream, over the
rows themselves, holds one row at a time.  It is one task per conversation, as a hash of the
whole repaired conversation and its audit, one string, are made one row after the other.

Defined cases: null role and text are one space, null turns come first, a null conversation
id is an id; rows of equal turn go by a hash of role and text; roles are told by their first
character alone, and one that is neither s, u nor a is rerolled or deleted; turns that are
no whole numbers are null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelflife.llm.shared import lists, run_folder, ship, stage

BLOCK = 4096
CHUNK = 1 << 18  # padded rows handled at once
FAR = 1 << 60  # the cost of what cannot be

DELETE, INSERT, KEEP, REROLE = range(4)
EDITS = "DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SYSTEM, USER, ASSISTANT = 1, 2, 3
#: States: nothing yet, after system, after user, after assistant.
START, BEGUN, ASKED, ANSWERED = range(4)
#: The state after an inserted or rerolled row.
NEXT = np.array([ASKED, ASKED, ANSWERED, ASKED])
#: What it costs to end from each state, by inserting what is missing.
CLOSING = np.array([0, 4, 2, 0])
#: The state after keeping a row, by its role; -1 where that may not be.
KEPT = np.array([[-1, -1, -1, -1], [BEGUN, -1, -1, -1], [ASKED, ASKED, -1, ASKED], [-1, -1, ANSWERED, -1]])


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults planted by a checksum of ``conv_id:turn``: the test of the repair."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    dice = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1])), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    text = F.when(dice == 1, "").when(dice == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(dice == 3, 2).otherwise(1)
    return rows.where(dice != 0).select(
        "conv_id",
        "turn",
        F.when(dice == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("_n"),
    ).drop("_n")


# ---------------------------------------------------------------- items and blocks


def _keyed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    keyed = rows.select(
        F.col(conv_col).alias("conv"),
        F.expr(f"try_cast(`{turn_col}` AS bigint)").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return keyed.withColumn("tie", F.unhex(F.sha2(whole, 256)))


def _items(keyed: DataFrame, folder: str) -> DataFrame:
    """One row per distinct (conversation, turn, role, text): role, fault and number of copies."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(0)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    counted = stage(
        keyed.select("conv", "turn", "tie", initial.alias("initial"), last.alias("last"))
        .withColumn("blank", F.col("last") == "")
        .withColumn("truncated", ~F.col("last").isin(".", "!", "?"))
        .groupBy("conv", "turn", "tie", "initial", "blank", "truncated")
        .agg(F.count("*").alias("copies")),
        f"{folder}/items",
    )
    # The first turn of what several turns say; a null turn comes before all.
    several = counted.groupBy("conv", "tie").agg(
        F.count("*").alias("n"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unset")
    )
    several = stage(
        several.where("n > 1").select(F.col("conv").alias("c"), F.col("tie").alias("t"), "least", "unset"),
        f"{folder}/several",
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("tie") == F.col("t"))
    again = F.col("turn").isNotNull() & (F.col("unset") | (F.col("turn") > F.col("least")))
    fault = (
        F.when(F.col("blank"), BLANK).when(F.coalesce(again, F.lit(False)), DUPLICATE).when(F.col("truncated"), TRUNCATED)
    )
    return counted.join(several, same, "left").select(
        "conv", "turn", "tie", F.col("initial").cast("bigint"), F.coalesce(fault, F.lit(0)).cast("bigint").alias("fault"), "copies"
    )


_LISTS = ["turn", "tie", "initial", "fault", "copies"]


def _cut(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's sorted items, in order, each with its matrix of costs."""
    part, seq, rest = TaskContext.get().partitionId(), 0, None
    for batch in _then_none(batches):
        if batch is None:
            rows, final = rest, True
        else:
            joined = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            rows, final = next(iter(joined.to_batches()), None), False
        if rows is None or not rows.num_rows:
            continue
        conv, n = rows.column(0), rows.num_rows
        differs = pc.fill_null(pc.not_equal(conv.slice(1), conv.slice(0, n - 1)), False)
        differs = pc.or_(differs, pc.xor(conv.slice(1).is_null(), conv.slice(0, n - 1).is_null()))
        fresh = np.concatenate([[True], differs.to_numpy(zero_copy_only=False)])
        begins = np.flatnonzero(fresh)
        place = np.arange(n) - begins[np.cumsum(fresh) - 1]
        starts = np.flatnonzero(place % block == 0)
        ends = np.append(starts[1:], n)
        if not final:  # the last block may go on
            rest, starts, ends = rows.slice(starts[-1]), starts[:-1], ends[:-1]
            rows = rows.slice(0, ends[-1] if len(ends) else 0)
        if not len(starts):
            continue
        sizes = ends - starts
        initial, fault = (rows.column(i).to_numpy() for i in (3, 4))
        matrices = np.zeros((len(starts), 4, 4), np.int64)
        for some, role, flaw in _padded(sizes, starts, initial, fault):
            end = np.where(np.eye(4, dtype=bool), 0, FAR)
            matrices[some] = _costs(role, flaw, sizes[some], np.repeat(end[None], len(some), 0))[0]
        numbers = np.arange(seq, seq + len(starts))
        seq += len(starts)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0).take(pa.array(starts)),
                pa.array(np.full(len(starts), part, np.int64)),
                pa.array(numbers),
                *[lists(rows.column(i + 1), sizes) for i in range(len(_LISTS))],
                lists(pa.array(matrices.reshape(-1)), np.full(len(starts), 16)),
            ],
            ["conv", "part", "seq", *_LISTS, "matrix"],
        )


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _padded(
    sizes: np.ndarray, starts: np.ndarray, initial: np.ndarray, fault: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(blocks, roles, faults) of blocks of like size; rows end in the last column."""
    order = np.argsort(-sizes, kind="stable")
    lo = 0
    while lo < len(order):
        widest = int(sizes[order[lo]])
        some = order[lo : lo + max(1, CHUNK // max(widest, 1))]
        lo += len(some)
        at = starts[some, None] + np.arange(widest) - (widest - sizes[some, None])
        inside = np.arange(widest) >= widest - sizes[some, None]
        at = np.where(inside, at, 0)
        yield some, np.where(inside, initial[at], 0), np.where(inside, fault[at], BLANK)


# ---------------------------------------------------------------- costs, arcs, ranks, paths


def _costs(role: np.ndarray, fault: np.ndarray, sizes: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The cost from each state before each row to the end, inserting first where that is cheaper.

    ``end`` is the cost after the last row, by block, exit (or 1) and state; blocks come in
    falling size.  One array per column and one for the end; a column in front of a block's
    first row repeats the cost at its first row.
    """
    widest = role.shape[1]
    made = [end]
    for column in reversed(range(widest)):
        n = int((sizes >= widest - column).sum())
        after, r = made[-1][:n], role[:n, column]
        stays = np.where(fault[:n, column] == TRUNCATED, 1, 0)[:, None, None]
        best = after + COST[DELETE]
        free = ((fault[:n, column] != BLANK) & (fault[:n, column] != DUPLICATE))[:, None, None]
        reroled = after[:, :, NEXT] + COST[REROLE] + stays
        to = KEPT[r]
        kept = np.take_along_axis(after, np.broadcast_to(np.maximum(to, 0)[:, None], after.shape), 2) + stays
        kept = np.where(to[:, None] >= 0, kept, FAR)
        best = np.where(free, np.minimum(best, np.minimum(reroled, kept)), best)
        inserted = best[:, :, NEXT] + COST[INSERT]  # one row, then another
        best = np.minimum(best, np.minimum(inserted, inserted[:, :, NEXT] + COST[INSERT]))
        whole = made[-1].copy()
        whole[:n] = np.minimum(best, FAR)
        made.append(whole)
    made.reverse()
    return [made[0].transpose(0, 2, 1)] if end.shape[1] == 4 else made


def _arcs(
    role: np.ndarray, fault: np.ndarray, sizes: np.ndarray, costs: list[np.ndarray], last: np.ndarray
) -> np.ndarray:
    """For each node (block, column, state) and edit the node it leads to on a cheapest path, else -1.

    Columns in front of a block's first row have no arcs; at the end only the last block of
    a conversation has, the rows that it must still insert.
    """
    count, widest = role.shape
    cost = np.stack([c[:, 0] for c in costs], 1)  # block, column, state
    node = np.arange(count * (widest + 1) * 4).reshape(count, widest + 1, 4)
    to = np.full((count, widest + 1, 4, 4), -1)
    here, ahead, beyond = cost[:, :-1], cost[:, 1:], node[:, 1:]
    inside = (np.arange(widest) >= widest - sizes[:, None])[:, :, None]
    free = inside & ((fault != BLANK) & (fault != DUPLICATE))[:, :, None]
    stays = (fault == TRUNCATED)[:, :, None].astype(np.int64)
    to[:, :-1, :, DELETE] = np.where(inside & (ahead + COST[DELETE] == here), beyond, -1)
    to[:, :-1, :, INSERT] = np.where(inside & (here[:, :, NEXT] + COST[INSERT] == here), node[:, :-1, NEXT], -1)
    to[:, :-1, :, REROLE] = np.where(free & (ahead[:, :, NEXT] + COST[REROLE] + stays == here), beyond[:, :, NEXT], -1)
    state = KEPT[role]
    may = free & (state >= 0)
    state = np.maximum(state, 0)
    kept = np.take_along_axis(ahead, state, 2) + stays == here
    to[:, :-1, :, KEEP] = np.where(may & kept, np.take_along_axis(beyond, state, 2), -1)
    for state in (BEGUN, ASKED):
        to[last, -1, state, INSERT] = node[last, -1, NEXT[state]]
    return to.reshape(-1, 4)


def _least_paths(to: np.ndarray, starts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and edits of the least path from each start; -1 behind its end.

    ``to`` has the next node by node and edit, -1 where there is no arc.
    """
    count = len(to)
    arc = to >= 0
    rank = np.full((count + 1, 4), 5, np.int64)  # the last node is the end, which ranks lowest
    rank[:-1][arc] = (np.nonzero(arc)[1] + 1).astype(np.int64)
    dead = np.append(~arc.any(1), True)
    rank[dead, 0] = 0
    ends = np.full((count + 1, 4), count)
    ends[:-1][arc] = to[arc]
    used = rank < 5
    length = 1
    while length < longest:
        choice = rank.argmin(1)
        best = rank[np.arange(count + 1), choice]
        met = ends[used]
        pair = rank[used] * (best.max() + 1) + best[met]
        rank = np.full_like(rank, len(pair) + 1)
        rank[used] = np.unique(pair, return_inverse=True)[1].reshape(-1)
        ends[used] = ends[met, choice[met]]
        length *= 2
    choice = rank.argmin(1)
    step = np.append(np.where(dead[:-1], count, to[np.arange(count), choice[:-1]]), count)
    doubled = [step]
    while 1 << len(doubled) < longest:
        doubled.append(doubled[-1][doubled[-1]])
    path = starts[:, None]
    for jump in reversed(doubled):
        path = np.stack([path, jump[path]], 2).reshape(len(starts), -1)
    edits = np.where(dead[path], -1, choice[path])
    return np.where(path == count, -1, path), edits


def _audits(
    role: np.ndarray, fault: np.ndarray, sizes: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[list[list[str | None]], np.ndarray]:
    """For each block and state at its start the audit and the state at its end; from START alone if first."""
    count, widest = role.shape
    costs = _costs(role, fault, sizes, end[:, None])
    to = _arcs(role, fault, sizes, costs, last)
    entry = np.array([(b, s) for b in range(count) for s in range(1 if first[b] else 4)])
    starts = (entry[:, 0] * (widest + 1) + widest - sizes[entry[:, 0]]) * 4 + entry[:, 1]
    path, edits = _least_paths(to, starts, 3 * widest + 4)
    audits: list[list[str | None]] = [[None] * 4 for _ in range(count)]
    exits = np.zeros((count, 4), np.int64)
    lengths = (edits >= 0).sum(1)
    exits[entry[:, 0], entry[:, 1]] = path[np.arange(len(path)), (path >= 0).sum(1) - 1] % 4
    letters = np.frombuffer(EDITS.encode(), np.uint8)[np.maximum(edits, 0)]
    for (b, s), row, n in zip(entry.tolist(), letters, lengths.tolist(), strict=True):
        audits[b][s] = row[:n].tobytes().decode()
    return audits, exits


# ---------------------------------------------------------------- streams over blocks


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost from every block's end; blocks come conversation by conversation, from the last back."""
    held, known, vector = None, object(), CLOSING
    for batch in batches:
        out = []
        for conv, part, seq, matrix in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            new = conv != known
            if held is not None:
                out.append((*held, new))
            if new:
                known, vector = conv, CLOSING
            held = (part, seq, vector.tolist(), new)
            vector = (np.array(matrix, np.int64).reshape(4, 4) + vector).min(axis=1)
        if out:
            yield _ends(out)
    if held is not None:
        yield _ends([(*held, True)])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["p", "s", "after", "last", "first"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the audits and the exits for the states in which they may be entered."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        by = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        offsets = by["initial"].offsets.to_numpy()
        sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
        initial, fault = (by[c].flatten().to_numpy() for c in ("initial", "fault"))
        after = by["after"].flatten().to_numpy().reshape(n, 4)
        first, last = (by[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("first", "last"))
        audits: list[list[str | None]] = [[]] * n
        exits = np.zeros((n, 4), np.int64)
        for some, role, flaw in _padded(sizes, starts, initial, fault):
            found, exits[some] = _audits(role, flaw, sizes[some], after[some], first[some], last[some])
            for i, audit in zip(some.tolist(), found, strict=True):
                audits[i] = audit
        keep = ["conv", "part", "seq", *_LISTS, "first", "last"]
        yield pa.RecordBatch.from_arrays(
            [*[by[c] for c in keep], pa.array(audits, pa.list_(pa.string())), lists(pa.array(exits.reshape(-1)), np.full(n, 4))],
            [*keep, "audits", "exits"],
        )


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which every block is entered; blocks come conversation by conversation, in order."""
    known, state = object(), START
    for batch in batches:
        rows = []
        for conv, part, seq, exits in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv != known:
                known, state = conv, START
            rows.append((part, seq, state))
            state = exits[state]
        if rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["p", "s", "entry"])


def _per_item(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per item: the rows inserted before it, its edit, those inserted behind it."""
    for batch in batches:
        by = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        before, edits, behind, sizes = [], [], [], []
        for audits, entry, items in zip(by["audits"].to_pylist(), by["entry"].to_pylist(), by["fault"].to_pylist(), strict=True):
            pieces = audits[entry or START]
            at = len(edits)
            waiting = 0
            for letter in pieces:
                if letter == EDITS[INSERT]:
                    waiting += 1
                else:
                    before.append(waiting)
                    edits.append(letter)
                    behind.append(0)
                    waiting = 0
            behind[-1] += waiting
            sizes.append(len(edits) - at)
            assert sizes[-1] == len(items)
        owner = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        yield pa.RecordBatch.from_arrays(
            [
                by["conv"].take(owner),
                *[by[c].flatten() for c in _LISTS],
                pa.array(before, pa.int64()),
                pa.array(edits, pa.string()),
                pa.array(behind, pa.int64()),
            ],
            ["conv", *_LISTS, "before", "edit", "behind"],
        )


def item_edits(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per distinct row of a conversation, without its text: what becomes of it.

    ``conv``, ``turn``, ``tie`` (a hash of role and text), ``initial``, ``fault`` (0, or 1
    blank, 2 duplicate, 3 truncated), ``copies``, ``before`` and ``behind`` (rows inserted),
    ``edit`` (of the first copy; others are deleted).  Writes four tables of small rows.
    """
    spark = rows.sparkSession
    ship(spark)
    folder = run_folder(spark)
    items = _items(_keyed(rows, conv_col, turn_col, role_col, text_col), folder)
    kind = items.schema["conv"].dataType.simpleString()
    block_lists = "turn array<bigint>, tie array<binary>, initial array<bigint>, fault array<bigint>, copies array<bigint>"
    order = ["conv", "turn", "tie"]
    blocks = items.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = stage(
        blocks.mapInArrow(
            lambda batches: _cut(batches, block),
            f"conv {kind}, part bigint, seq bigint, {block_lists}, matrix array<bigint>",
        ),
        f"{folder}/blocks",
    )
    back = blocks.select("conv", "part", "seq", "matrix").repartition("conv")
    back = back.sortWithinPartitions("conv", F.desc("part"), F.desc("seq"))
    ends = back.mapInArrow(_backward, "p bigint, s bigint, after array<bigint>, last boolean, first boolean")
    ends = stage(ends, f"{folder}/ends")
    here = (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s"))
    found = stage(
        blocks.drop("matrix").join(ends, here).drop("p", "s").mapInArrow(
            _search,
            f"conv {kind}, part bigint, seq bigint, {block_lists}, first boolean, last boolean,"
            " audits array<string>, exits array<bigint>",
        ),
        f"{folder}/found",
    )
    several = found.where("NOT (first AND last)").select("conv", "part", "seq", "exits")
    several = several.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    entries = several.mapInArrow(_forward, "p bigint, s bigint, entry bigint")
    entered = found.join(stage(entries, f"{folder}/entries"), here, "left").drop("p", "s")
    return entered.mapInArrow(
        _per_item,
        f"conv {kind}, turn bigint, tie binary, initial bigint, fault bigint, copies bigint,"
        " before bigint, edit string, behind bigint",
    )


# ---------------------------------------------------------------- the rows, repaired


class _Walk:
    """A conversation as its edits and rows come by, in order."""

    def __init__(self, emit: Callable[[str, str, str], None]) -> None:
        self.emit = emit
        self.state, self.before = START, None
        self.counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal = self.cost = self.distinct = self.behind = 0
        self.least = self.most = None
        self.audit: list[str] = []
        self.edit = ""

    def insert(self, times: int) -> None:
        for _ in range(times):
            self.state = int(NEXT[self.state])
            self.emit(EDITS[INSERT], "user" if self.state == ASKED else "assistant", "")
        self.cost += COST[INSERT] * times
        self.audit.append(EDITS[INSERT] * times)

    def item(self, turn, initial, fault, copies, before, edit, behind) -> None:
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.distinct += 1
        if fault:
            self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        legal = self.before is None or (self.before, initial) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
        self.illegal += (not legal) + copies - 1
        self.before = initial
        self.insert(before)
        self.edit, self.initial, self.behind = edit, initial, behind
        self.cost += COST[EDITS.index(edit)] + COST[DELETE] * (copies - 1)
        self.cost += fault == TRUNCATED and edit != EDITS[DELETE]
        self.audit.append(edit + EDITS[DELETE] * (copies - 1))

    def row(self, role: str, text: str) -> None:
        """The first copy is what the edit is for, the others are deleted."""
        if self.edit == EDITS[KEEP]:
            self.state = int(KEPT[self.initial, self.state])
            self.emit(self.edit, role, text)
        elif self.edit == EDITS[REROLE]:
            self.state = int(NEXT[self.state])
            self.emit(self.edit, "user" if self.state == ASKED else "assistant", text)
        self.edit = ""
        if self.behind:
            times, self.behind = self.behind, 0
            self.insert(times)


_STREAM = ["conv", "kind", "turn", "initial", "fault", "copies", "before", "edit", "behind", "role", "text"]


def _stream(rows: DataFrame, edits: DataFrame, ids: DataFrame | None, columns: tuple[str, str, str, str]) -> DataFrame:
    """Ids, edits and rows of each conversation, in order, an item's edit before its copies."""
    keyed = _keyed(rows, *columns)
    stream = edits.withColumn("kind", F.lit(1)).unionByName(keyed.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    if ids is not None:
        known = ids.select(F.col(columns[0]).alias("conv")).distinct().withColumn("kind", F.lit(0))
        stream = stream.unionByName(known, allowMissingColumns=True)
    order = ["conv", F.when(F.col("kind") == 0, 0).otherwise(1), "turn", "tie", "kind"]
    return stream.repartition("conv").sortWithinPartitions(*order).select(*_STREAM)


def _walked(batches: Iterator[pa.RecordBatch], begin: Callable, end: Callable) -> Iterator[tuple]:
    walk, known = None, None
    for batch in batches:
        for conv, kind, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if walk is None or conv != known:
                if walk is not None:
                    yield end(known, walk)
                walk, known = begin(), conv
            if kind == 1:
                walk.item(*rest[:7])
            elif kind == 2:
                walk.row(*rest[7:])
    if walk is not None:
        yield end(known, walk)


def _digests(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    def begin() -> _Walk:
        digest, some = hashlib.sha256(), []

        def emit(_: str, role: str, text: str) -> None:
            if some:
                digest.update(b"\n")
            some[:] = [True]
            digest.update(f"{role}:{text}".encode())

        walk = _Walk(emit)
        walk.digest = digest
        return walk

    def end(conv, walk: _Walk) -> tuple:
        gaps = 0 if walk.most is None else walk.most - walk.least + 1 - walk.distinct
        counts = [walk.counts[c] for c in (BLANK, DUPLICATE, TRUNCATED)]
        return (conv, gaps, *counts, walk.illegal, walk.cost, "".join(walk.audit), walk.digest.hexdigest())

    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    for rows in _grouped(_walked(batches, begin, end), 1000):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, DIGEST)


DIGEST = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _grouped(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _turns(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    held: list[list] = [[], [], [], [], []]
    kinds = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string()]

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], TURNS)
        for column in held:
            column.clear()
        return batch

    walk, known, n = None, None, 0

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal n
        for column, value in zip(held, (known, n, edit, role, text), strict=True):
            column.append(value)
        n += 1

    for batch in batches:
        for conv, kind, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if walk is None or conv != known:
                walk, known, n = _Walk(emit), conv, 0
            if kind == 1:
                walk.item(*rest[:7])
                walk.audit.clear()
            else:
                walk.row(*rest[7:])
        if held[0]:
            yield flushed()


TURNS = ["conv", "n", "edit", "role", "text"]


def repaired(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """The rows of the repaired conversations: ``conv``, ``n`` from 0, ``edit``, ``role``, ``text``."""
    columns = (conv_col, turn_col, role_col, text_col)
    stream = _stream(rows, item_edits(rows, *columns, block), None, columns)
    kind = stream.schema["conv"].dataType
    arrow = to_arrow_type(kind)
    return stream.mapInArrow(
        lambda batches: _turns(batches, arrow), f"conv {kind.simpleString()}, n bigint, edit string, role string, text string"
    )


def repair_report(
    rows: DataFrame,
    ids: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per conversation: faults found, cost, audit, and the SHA-256 of what is left.

    ``ids`` has conversations that are reported even if they have no rows.
    """
    columns = (conv_col, turn_col, role_col, text_col)
    stream = _stream(rows, item_edits(rows, *columns, block), ids, columns)
    kind = stream.schema["conv"].dataType
    arrow = to_arrow_type(kind)
    counts = ", ".join(f"{c} bigint" for c in DIGEST[1:7])
    return stream.mapInArrow(
        lambda batches: _digests(batches, arrow), f"conv {kind.simpleString()}, {counts}, audit string, repaired_sha256 string"
    )
