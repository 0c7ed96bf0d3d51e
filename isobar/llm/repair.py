"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Reading it row by
row there are four states: nothing yet, after a system row, after a user row,
after an assistant row.  Every row is kept, reroled or deleted, and empty rows
may be inserted before it, so a row is one of nine kinds of a 4 x 4 matrix of
costs, each with the edits that reach it.

A run of rows is halved: the cost vector of its first half, carried forward
from the entry state, meets the vector of the second half, carried back from
the exit state.  Among the crossing states of least total cost the one with
the least edits wins (the forward vector carries the order of its four edit
strings, so no string is built), and both halves are solved the same way.
All runs of a batch are halved side by side, with numpy; memory stays linear.

No conversation has to fit in a task.  Rows are range-partitioned in their
order and cut into blocks of ``BLOCK`` rows.  A block is one matrix of the same
shape, so the crossings at the blocks' borders are found first, from the
matrices alone, and then every block is solved by itself.
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

from isobar.llm.common import arrow_map, written

BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = (None, "system", "user", "assistant")
#: State that a user or assistant row may lead to.
NEXT = (USER, USER, ASSISTANT, USER)
INF = 1 << 50
#: Kinds of rows: class of the role (s, u, a, other) * 2 + truncated, or this one.
MUST_DELETE = 8
SPACE = r"\x20\x09-\x0D"


def _options(kind: int) -> tuple[np.ndarray, list[list[str | None]]]:
    """Least cost, and the ASCII-least edits of that cost, between two states over a row of this kind."""
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    extra = TRUNCATED * (kind % 2)
    for p in range(4):
        r, spent = p, 0
        for n in range(4):  # more inserts would come back to a state
            ways = [(DELETE, "D", r)]
            if kind != MUST_DELETE:
                ways.append((REROLE + extra, "R", NEXT[r]))
                if kind // 2 == 0 and r == NONE:
                    ways.append((KEEP + extra, "K", SYSTEM))
                if kind // 2 in (1, 2) and NEXT[r] == kind // 2 + 1:
                    ways.append((KEEP + extra, "K", NEXT[r]))
            for cost, edit, q in ways:
                found = (spent + cost, "I" * n + edit)
                if best[p][q] is None or found < best[p][q]:
                    best[p][q] = found
            r, spent = NEXT[r], spent + INSERT
    cost = np.array([[INF if x is None else x[0] for x in row] for row in best], np.int64)
    return cost, [[None if x is None else x[1] for x in row] for row in best]


def _roles(p: int, edits: str) -> list[tuple[str, str | None]]:
    """Each edit with the role it gives its row (None: the row's own)."""
    out = []
    for e in edits:
        if e in "IR":
            p = NEXT[p]
            out.append((e, ROLES[p]))
        else:
            out.append((e, None))
    return out


_ALL = [_options(k) for k in range(9)]
KIND_COST = np.stack([c for c, _ in _ALL])
#: Order of the edit strings that leave the same state.
KIND_ORDER = np.array([[[0 if x is None else sum(y is not None and y < x for y in row) for x in row] for row in texts]
                       for _, texts in _ALL], np.int64)
#: Rows that close a conversation: from each state to an allowed end.
END = ("", "II", "I", "")
END_COST = np.array([INSERT * len(x) for x in END], np.int64)
#: Edits and roles by kind * 16 + entry * 4 + exit, and those that close at 144 + state.
EDITS = [_roles(p, texts[p][q] or "") for _, texts in _ALL for p in range(4) for q in range(4)] + [_roles(p, END[p]) for p in range(4)]


def forward(cost: np.ndarray, order: np.ndarray, start: np.ndarray, end: np.ndarray, entry: np.ndarray,
            seen: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(cost, rank) per run and state behind elements start..end, entered in ``entry``.

    ``cost`` and ``order`` are 4 x 4 per element.  Ranks order the states' edit
    strings.  ``seen(live, k, cost, rank)`` is called behind every element.
    """
    m = len(start)
    have, rank = np.full((m, 4), INF, np.int64), np.zeros((m, 4), np.int64)
    have[np.arange(m), entry] = 0
    length = end - start
    for k in range(int(length.max(initial=0))):
        live = np.flatnonzero(length > k)
        e = start[live] + k
        total = np.minimum(have[live][:, :, None] + cost[e], INF)
        best = ((total << 4) + (rank[live][:, :, None] << 2) + order[e]).min(axis=1)
        place = best & 15
        have[live] = best >> 4
        rank[live] = (place[:, :, None] > place[:, None, :]).sum(axis=2)
        if seen is not None:
            seen(live, k, have[live], rank[live])
    return have, rank


def backward(cost: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray, seen: Callable | None = None) -> np.ndarray:
    """Least cost from each state ahead of elements start..end to the costs ``last`` behind them."""
    need = last.copy()
    length = end - start
    for k in range(int(length.max(initial=0))):
        live = np.flatnonzero(length > k)
        if seen is not None:
            seen(live, k, need[live])
        need[live] = np.minimum((cost[end[live] - 1 - k] + need[live][:, None, :]).min(axis=2), INF)
    return need


def _at(state: np.ndarray) -> np.ndarray:
    """Cost vectors that allow one state."""
    out = np.full((len(state), 4), INF, np.int64)
    out[np.arange(len(state)), state] = 0
    return out


def _least(total: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of the states with the least total, the one with the least edits."""
    return np.where(total == total.min(axis=1, keepdims=True), rank, 9).argmin(axis=1)


def solve(kinds: np.ndarray, start: np.ndarray, end: np.ndarray, entry: np.ndarray, exit_: np.ndarray) -> np.ndarray:
    """Index into EDITS of every row, by divide and conquer over all runs side by side."""
    code = np.zeros(len(kinds), np.int64)
    cost, order = KIND_COST[kinds], KIND_ORDER[kinds]
    while len(start):
        one = end - start == 1
        code[start[one]] = kinds[start[one]] * 16 + entry[one] * 4 + exit_[one]
        more = end - start > 1
        s, e, p, q = start[more], end[more], entry[more], exit_[more]
        mid = (s + e) // 2
        have, rank = forward(cost, order, s, mid, p)
        x = _least(have + backward(cost, mid, e, _at(q)), rank)
        start, end, entry, exit_ = (np.concatenate(v) for v in ((s, mid), (mid, e), (p, x), (x, q)))
    return code


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows dropped, emptied, stripped of stops, repeated or reroled by hash."""
    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.pmod(F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")), F.lit(20))
    text = F.when(h == 1, "").when(h == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return conversations.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies")).where("copies > 0")


def plain(conversations: DataFrame) -> DataFrame:
    """The rows as they are (nulls: one space), for real conversations."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", "turn", *shown, F.lit(1).alias("copies"))


def _judged(rows: DataFrame) -> DataFrame:
    """One slim row per row and copy: order keys, kind and first fault."""
    digest = F.unhex(F.sha2("text", 256))
    slim = rows.select(
        "conv_id", "turn", "role", digest.alias("digest"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "place",
        F.col("text").rlike(f"[^{SPACE}]").alias("said"), F.col("text").rlike(rf"[.!?][{SPACE}]*\z").alias("stopped"))
    slim = slim.withColumn("place", F.col("place") + F.col("copy")).drop("copy")
    # rows that are said twice or more: summed map-side; a hot one is one row here
    again = (slim.where("said").groupBy("conv_id", "role", "digest")
             .agg(F.count("*").alias("n"), F.min(F.struct("turn", "place")).alias("first")).where("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    met = slim.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    duplicate = F.coalesce(F.col("first.place") != F.col("place"), F.lit(False))
    initial = F.substring("role", 1, 1)
    cls = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(~F.col("said"), 1).when(duplicate, 2).when(~F.col("stopped"), 3).otherwise(0)
    return (met.withColumn("cls", cls).withColumn("fault", fault)
            .select("conv_id", "turn", "role", "digest", "place", F.col("cls").cast("byte").alias("cls"), F.col("fault").cast("byte").alias("fault")))


_COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "n_turns", "first_turn", "last_turn", "first_cls", "last_cls")
_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _codes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equal numbers for equal values, null included."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks of at most BLOCK rows of one conversation."""
    serial = TaskContext.get().partitionId() << 33
    rest = None
    for batch in _with_end(batches):
        last = batch is None
        rows = rest if last else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if rows is None or not rows.num_rows:
            continue
        ids = _codes(rows.column("conv_id"))
        edge = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)]
        start = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(edge[:-1], edge[1:])])
        end = np.minimum(np.repeat(edge[1:], -(-np.diff(edge) // BLOCK)), start + BLOCK)
        if not last:  # the last block may go on in the next batch
            rest = rows.slice(int(start[-1]))
            start, end = start[:-1], end[:-1]
        if len(start):
            yield _blocks(rows, start, end, serial)
            serial += len(start)


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _blocks(rows: pa.Table, start: np.ndarray, end: np.ndarray, serial: int) -> pa.RecordBatch:
    m = int(end[-1])
    cls, fault = (rows.column(c).to_numpy()[:m].astype(np.int64) for c in ("cls", "fault"))
    kinds = np.where((fault == 1) | (fault == 2), MUST_DELETE, cls * 2 + (fault == 3))
    have = np.stack([np.stack(forward(KIND_COST[kinds], KIND_ORDER[kinds], start, end, np.full(len(start), p))) for p in range(4)], axis=2)
    turn = rows.column("turn").combine_chunks().slice(0, m)
    known = pc.is_valid(turn).to_numpy(zero_copy_only=False)
    value = pc.fill_null(turn, 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def per(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[end] - total[start]

    inner = np.ones(m, bool)
    inner[start] = False
    before = np.r_[0, cls[:-1]]
    fits = ((before == 0) & (cls == 1)) | ((before == 1) & (cls == 2)) | ((before == 2) & (cls == 1))
    fresh = known & ~(inner & np.r_[False, known[:-1]] & (value == np.r_[0, value[:-1]]))
    # nulls come first, so a block's known turns end it
    n_known = per(known)
    counts = {"n": end - start, "blank": per(fault == 1), "duplicate": per(fault == 2), "truncated": per(fault == 3),
              "illegal": per(inner & ~fits), "n_turns": per(fresh), "first_cls": cls[start], "last_cls": cls[end - 1]}
    turns = {"first_turn": value[np.minimum(end - n_known, m - 1)], "last_turn": value[end - 1]}
    offsets = pa.array(np.r_[start, end[-1:]].astype(np.int32))
    cut = {
        "conv_id": rows.column("conv_id").combine_chunks().take(pa.array(start)),
        "block": pa.array(serial + np.arange(len(start))),
        "kinds": pa.ListArray.from_arrays(offsets, pa.array(kinds.astype(np.int8))),
        "places": pa.ListArray.from_arrays(offsets, rows.column("place").combine_chunks().slice(0, m)),
        "costs": pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1, dtype=np.int32) * 16), pa.array(have[0].ravel())),
        "ranks": pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1, dtype=np.int32) * 16), pa.array(have[1].ravel()))}
    cut |= {k: pa.array(v) for k, v in counts.items()} | {k: pa.array(v, mask=n_known == 0) for k, v in turns.items()}
    return pa.RecordBatch.from_pydict(cut)


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation: entry and exit state of each, and the conversation's counts on its last one."""
    rest = None
    for batch in _with_end(batches):
        rows = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if rows is None or not rows.num_rows:
            continue
        ids = _codes(rows.column("conv_id"))
        edge = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)]
        if batch is not None:  # the last conversation may go on
            rest, edge = rows.slice(int(edge[-2])), edge[:-1]
        if len(edge) > 1:
            yield _crossed(rows.slice(0, int(edge[-1])), edge[:-1], edge[1:])


def _crossed(rows: pa.Table, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    n = rows.num_rows
    cost, order = (rows.column(c).combine_chunks().flatten().to_numpy().reshape(n, 4, 4) for c in ("costs", "ranks"))
    have, rank, need = np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)

    def ahead(live, k, c, r):
        have[start[live] + k], rank[start[live] + k] = c, r

    def behind(live, k, c):
        need[end[live] - 1 - k] = c

    forward(cost, order, start, end, np.zeros(len(start), np.int64), ahead)
    backward(cost, start, end, np.repeat(END_COST[None], len(start), axis=0), behind)
    leaves = _least(have + need, rank)
    enters = np.r_[0, leaves[:-1]]
    enters[start] = NONE
    c = {k: rows.column(k).combine_chunks() for k in _COUNTS}
    v = {k: pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for k, x in c.items()}
    known = pc.is_valid(c["first_turn"]).to_numpy(zero_copy_only=False)
    joined = np.ones(n, bool)
    joined[start] = False
    before = np.r_[0, v["last_cls"][:-1]]
    now = v["first_cls"]
    fits = ((before == 0) & (now == 1)) | ((before == 1) & (now == 2)) | ((before == 2) & (now == 1))
    same = joined & known & np.r_[False, known[:-1]] & (v["first_turn"] == np.r_[0, v["last_turn"][:-1]])

    def per(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x.astype(np.int64), start)

    low = np.minimum.reduceat(np.where(known, v["first_turn"], np.iinfo(np.int64).max), start)
    high = np.maximum.reduceat(np.where(known, v["last_turn"], np.iinfo(np.int64).min), start)
    some = per(known) > 0
    gaps = np.where(some, np.where(some, high, 0) - np.where(some, low, 0) + 1 - per(v["n_turns"] - same), 0)
    found = {"gaps": gaps, "blank": per(v["blank"]), "duplicate": per(v["duplicate"]), "truncated": per(v["truncated"]),
             "illegal": per(v["illegal"] + (joined & ~fits)), "cost": (have + need)[end - 1].min(axis=1)}
    closes = np.zeros(n, bool)
    closes[end - 1] = True
    out = {"conv_id": rows.column("conv_id").combine_chunks(), "block": rows.column("block").combine_chunks(),
           "enters": pa.array(enters.astype(np.int8)), "leaves": pa.array(leaves.astype(np.int8)), "closes": pa.array(closes)}
    for k, x in found.items():
        at = np.zeros(n, np.int64)  # the Arrow array keeps it
        at[end - 1] = x
        out[k] = pa.array(at, mask=~closes)
    return pa.RecordBatch.from_pydict(out)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their entry and exit states to one row per edit."""
    size = np.array([len(x) for x in EDITS])
    base = np.r_[0, np.cumsum(size)]
    edit, role = (pa.array([x[i] for option in EDITS for x in option], pa.string()) for i in (0, 1))
    takes = np.array([x[0] != "I" for option in EDITS for x in option])
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.list_value_length(batch.column("kinds")).to_numpy().astype(np.int64)
        end = np.cumsum(length)
        kinds = batch.column("kinds").flatten().to_numpy().astype(np.int64)
        enters, leaves = (batch.column(c).to_numpy().astype(np.int64) for c in ("enters", "leaves"))
        code = solve(kinds, end - length, end, enters, leaves)
        # a conversation's last block also closes it
        closes = batch.column("closes").to_numpy(zero_copy_only=False)
        code = np.insert(code, end[closes], 144 + leaves[closes])
        place = np.insert(batch.column("places").flatten().to_numpy(), end[closes], -1)
        of = np.repeat(np.arange(len(end)), length + closes)
        n = size[code]
        which = np.repeat(base[:-1][code], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        of, place = np.repeat(of, n), np.repeat(place, n)
        if not len(of):
            continue
        first = np.searchsorted(of, of)
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch.column("conv_id").take(pa.array(of)), "block": batch.column("block").take(pa.array(of)),
            "pos": pa.array((np.arange(len(of)) - first).astype(np.int32)), "edit": edit.take(pa.array(which)),
            "place": pa.array(place, mask=~takes[which]), "new_role": role.take(pa.array(which))})


def _named(df: DataFrame, column: str, kind: str) -> str:
    return f"`{column}` {df.schema[kind].dataType.simpleString()}"


class Repair:
    """What a repair finds; all parts are written tables.

    ``counts`` has one row per conversation with rows: gaps, faults and cost.
    ``edits`` has one row per edit, in the order (block, pos): edit (K, R, D or
    I), the place of its row in ``rows`` and the role it gives.
    """

    def __init__(self, rows: DataFrame):
        conv = _named(rows, "conv_id", "conv_id")
        self.rows = written(rows.withColumn("place", F.monotonically_increasing_id() * 2), "repair-rows")
        keys = ["conv_id", "turn", "role", "digest", "place"]
        ordered = written(_judged(self.rows), "repair-judged").repartitionByRange(*keys).sortWithinPartitions(*keys)
        blocks = written(arrow_map(
            ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "place", "cls", "fault"), _cut,
            f"{conv}, block long, kinds array<tinyint>, places array<long>, costs array<long>, ranks array<long>, "
            "n long, blank long, duplicate long, truncated long, illegal long, n_turns long, first_cls long, last_cls long, "
            "first_turn long, last_turn long"), "repair-blocks")
        # a few numbers per block; one task takes a conversation's blocks in order
        crossed = written(arrow_map(
            blocks.drop("kinds", "places").repartition("conv_id").sortWithinPartitions("conv_id", "block"), _crossings,
            f"{conv}, block long, enters tinyint, leaves tinyint, closes boolean, {_FOUND}"), "repair-crossings")
        self.counts = crossed.where("closes").drop("block", "enters", "leaves", "closes")
        states = crossed.select(F.col("block").alias("b"), "enters", "leaves", "closes")
        self.edits = written(arrow_map(
            blocks.select("conv_id", "block", "kinds", "places").join(states, F.col("block") == F.col("b")).drop("b"), _edits,
            f"{conv}, block long, pos int, edit string, place long, new_role string"), "repair-edits")

    def repaired(self) -> DataFrame:
        """One row per edit with the repaired role and text (null for a deleted row), in the order (conv_id, block, pos)."""
        kept = self.edits.where(F.col("edit").isin("K", "R"))
        texts = self.rows.select(F.col("place").alias("p"), "role", "text")
        kept = (kept.join(texts, F.shiftleft(F.shiftright("place", 1), 1) == F.col("p"))
                .select("conv_id", "block", "pos", "edit", F.coalesce("new_role", "role").alias("role"), "text"))
        gone = self.edits.where(~F.col("edit").isin("K", "R")).select(
            "conv_id", "block", "pos", "edit", F.col("new_role").alias("role"), F.when(F.col("edit") == "I", "").alias("text"))
        return kept.unionByName(gone)


def repair(conversations: DataFrame) -> Repair:
    """Repair conversations as they are.

    Columns conv_id, turn, role and text are used, others ignored whatever
    their names.  A conversation's rows are taken by turn (nulls first), then
    role, then content; equal rows count as repetitions.  Null role or text:
    one space.  A null conv_id is a conversation.  Roles with another initial
    than s, u or a (an empty role too) cannot be kept.  An empty table gives
    empty parts.  Texts of any length are only hashed, joined and streamed.
    """
    return Repair(plain(conversations))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and position: the edits and the hash of the repaired lines, streamed."""
    held, audit, sha, lines = None, [], None, 0

    def close() -> None:
        done["audit"].append("".join(audit))
        done["repaired_sha256"].append(sha.hexdigest())

    for batch in _with_end(batches):
        done: dict[str, list] = {"audit": [], "repaired_sha256": []}
        ids: list[pa.Array] = []
        if batch is None:
            if held is not None:
                ids.append(held)
                close()
        elif batch.num_rows:
            conv = batch.column("conv_id")
            code = _codes(conv)
            edge = np.r_[0, np.flatnonzero(code[1:] != code[:-1]) + 1, len(code)]
            edits, line = batch.column("edit").to_pylist(), batch.column("line")
            for k, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
                if k or held is None or held[0].as_py() != conv[a].as_py():
                    if held is not None:
                        ids.append(held)
                        close()
                    held, audit, sha, lines = conv.slice(a, 1), [], hashlib.sha256(), 0
                audit.append("".join(edits[a:b]))
                for i in range(a, b):
                    if edits[i] != "D":
                        sha.update(("\n" if lines else "").encode() + line[i].as_py().encode())
                        lines += 1
        if ids:
            yield pa.RecordBatch.from_pydict({"conv_id": pa.concat_arrays(ids), **done})


def audit(conversations: DataFrame) -> DataFrame:
    """Damage conversations by hash, repair them, and report every original conv_id.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256.  Nulls, ties, repeated rows, extra columns and long
    texts: see :func:`repair`.  A conversation that loses all its rows: zeros,
    an empty audit and the hash of the empty string.  An empty table: no rows.
    """
    found = Repair(damaged(conversations))
    lines = found.repaired().select("conv_id", "block", "pos", "edit", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = arrow_map(lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos").select("conv_id", "edit", "line"),
                        _digests, _named(conversations, "conv_id", "conv_id") + ", audit string, repaired_sha256 string")
    every = conversations.select(F.col("conv_id").alias("c")).distinct()
    texts = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    numbers = [x.split()[0] for x in _FOUND.split(", ")]
    counts = found.counts.withColumnRenamed("conv_id", "a")
    digests = digests.withColumnRenamed("conv_id", "b")
    return (every.join(counts, F.col("c").eqNullSafe(F.col("a")), "left").join(digests, F.col("c").eqNullSafe(F.col("b")), "left")
            .select(F.col("c").alias("conv_id"), *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in numbers],
                    *[F.coalesce(x, F.lit(v)).alias(x) for x, v in texts.items()]))
