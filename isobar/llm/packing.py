"""Best-fit packing with swap-based local search.

Pieces are dealt by hash to groups of about ``GROUP``; a task packs a group.
It starts from best fit (longest first, fullest bin that takes the piece), then
improves the bins that are not full: the fullest of them takes documents from
the others, by a move, an exchange of one for one, of two for one or of one for
two, whichever fills it best.  Every such step raises the sum of squared
fills, as documents leave emptier bins for fuller ones, until bins are empty.

Bins that stay underfull are dealt again, with those of other groups, in the
next round, until they fit in one group or no longer become fewer.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import written
from isobar.llm.tokens import TOKENIZER, pieces
from isobar.session import ship_package

CAPACITY = 4096
#: Pieces that a task packs at a time.
GROUP = 16384
#: Share of the capacity that a bin may lack and still counts as full.
SLACK = 1 / 512
ROUNDS = 6


def best_fit(length: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, into the fullest bin with room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: there is a bin with room r
    for i in np.argsort(-length, kind="stable").tolist():
        s = int(length[i])
        fits = open_rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
            room -= s
        else:
            b, room = len(bins), capacity - s
            bins.append([])
        bins[b].append(i)
        if room:
            by_room[room].append(b)
            open_rooms |= 1 << room
    return bins


class Pool:
    """Bins that are not full, and which of them hold an item of each length."""

    def __init__(self, bins: list[list[int]], length: list[int], capacity: int):
        self.length, self.capacity, self.items = length, capacity, bins
        self.fill = [sum(length[i] for i in b) for b in bins]
        self.holders: list[dict[int, int]] = [{} for _ in range(capacity + 1)]
        self.sizes = 0  # bit s: some bin holds an item of length s
        for b in range(len(bins)):
            self.enter(b)

    def _note(self, s: int, b: int, more: int) -> None:
        h = self.holders[s]
        n = h.get(b, 0) + more
        if n:
            h[b] = n
        else:
            del h[b]
        self.sizes = self.sizes | 1 << s if h else self.sizes & ~(1 << s)

    def enter(self, b: int, sign: int = 1) -> None:
        for i in self.items[b]:
            self._note(self.length[i], b, sign)

    def leave(self, b: int) -> None:
        self.enter(b, -1)

    def largest(self, at_most: int) -> int:
        """The longest item in the pool of at most this length; 0 if there is none."""
        return max((self.sizes & ((1 << at_most + 1) - 1)).bit_length() - 1, 0)

    def two(self, low: int, high: int) -> tuple[int, int]:
        """Lengths of two items with the largest sum in (low, high]; (0, 0) if there are none."""
        best, rest = (0, 0), self.sizes & ((1 << max(high, 1)) - 1)
        while rest:
            a = rest.bit_length() - 1
            if 2 * a <= max(low, sum(best)):
                break
            rest ^= 1 << a
            b = self.largest(min(a, high - a))
            if b == a and sum(self.holders[a].values()) < 2:
                b = self.largest(a - 1)
            if b and max(low, sum(best)) < a + b <= high:
                best = a, b
                if a + b == high:
                    break
        return best

    def emptiest(self, s: int) -> int:
        return min(self.holders[s], key=lambda b: (self.fill[b], b))

    def take(self, s: int) -> tuple[int, int]:
        """Remove an item of length s from the emptiest bin that has one: (item, bin)."""
        b = self.emptiest(s)
        i = next(i for i in self.items[b] if self.length[i] == s)
        self.put_out(b, i)
        return i, b

    def put_out(self, b: int, i: int) -> None:
        self.items[b].remove(i)
        self.fill[b] -= self.length[i]
        self._note(self.length[i], b, -1)

    def put_in(self, b: int, i: int) -> None:
        self.items[b].append(i)
        self.fill[b] += self.length[i]
        self._note(self.length[i], b, 1)


def _ways(pool: Pool, own: list[int], gap: int) -> list[tuple[int, int, tuple[int, ...], tuple[int, ...]]]:
    """Steps that raise a bin's fill by at most its gap: (gain, -documents moved, lengths in, items out), best first."""
    length, out = pool.length, []
    if s := pool.largest(gap):
        out.append((s, -1, (s,), ()))
    seen = set()
    for i in own:
        x = length[i]
        if x in seen:
            continue
        seen.add(x)
        if (y := pool.largest(x + gap)) > x:
            out.append((y - x, -2, (y,), (i,)))
        a, b = pool.two(x, x + gap)
        if b:
            out.append((a + b - x, -3, (a, b), (i,)))
    some = sorted(own, key=length.__getitem__)
    for j, i in enumerate(some):
        for k in some[j + 1:]:
            x = length[i] + length[k]
            if x + 1 > pool.capacity:
                break
            if (y := pool.largest(min(x + gap, pool.capacity))) > x:
                out.append((y - x, -3, (y,), (i, k)))
    return sorted(out, key=lambda w: (-w[0], -w[1], w[2]))


def improve(bins: list[list[int]], length: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over the bins that are not full; empty bins vanish."""
    size = length.tolist()
    full = [b for b in bins if sum(size[i] for i in b) == capacity]
    pool = Pool([b for b in bins if sum(size[i] for i in b) < capacity], size, capacity)
    turn = [(-f, b) for b, f in enumerate(pool.fill)]
    heapq.heapify(turn)
    closed = set()
    while turn:
        f, b = heapq.heappop(turn)
        if b in closed or -f != pool.fill[b] or not pool.fill[b]:
            continue
        # the fullest bin: all others are emptier, so whatever it gains raises the squares
        closed.add(b)
        pool.leave(b)
        while pool.fill[b] < capacity and (done := _step(pool, b)):
            for other in done:
                heapq.heappush(turn, (-pool.fill[other], other))
    return full + [b for b in pool.items if b]


def _step(pool: Pool, b: int) -> set[int]:
    """Take the best step that can be taken; the other bins it changed."""
    for _, _, lengths, outs in _ways(pool, pool.items[b], pool.capacity - pool.fill[b]):
        gain = sum(lengths) - sum(pool.length[i] for i in outs)
        before = pool.fill.copy() if len(lengths) > 1 else None  # of a group's bins
        came = [pool.take(s) for s in lengths]
        changed = {o for _, o in came}
        # what leaves goes where there is room
        goes: list[tuple[int, int]] = []
        for i in outs:
            home = next((o for o in sorted(changed) if pool.fill[o] + pool.length[i] <= pool.capacity), None)
            if home is None:
                break
            pool.put_in(home, i)
            goes.append((home, i))
        # two bins may give, and the emptier of them take what leaves
        worse = before is not None and ((pool.fill[b] + gain) ** 2 - pool.fill[b] ** 2
                                        + sum(pool.fill[o] ** 2 - before[o] ** 2 for o in changed)) <= 0
        if len(goes) < len(outs) or worse:
            for home, i in goes:
                pool.put_out(home, i)
            for i, o in came:
                pool.put_in(o, i)
            continue
        for i in outs:
            pool.items[b].remove(i)
            pool.fill[b] -= pool.length[i]
        for i, _ in came:
            pool.items[b].append(i)
            pool.fill[b] += pool.length[i]
        return changed
    return set()


def pack_group(length: np.ndarray, capacity: int) -> list[list[int]]:
    return improve(best_fit(length, capacity), length, capacity)


def _packer(capacity: int, turn: int) -> Callable[[pa.Table], pa.Table]:
    def pack(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("row").to_numpy(), kind="stable")  # whatever order the rows came in
        rows = rows.take(pa.array(order))
        length = rows.column("length").to_numpy().astype(np.int64)
        base = (turn << 56) + (int(rows.column("grp")[0].as_py()) << 28)
        sequence, offset, full = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), np.zeros(len(length), bool)
        for k, items in enumerate(pack_group(length, capacity)):
            ends = np.cumsum(length[items])
            sequence[items], offset[items] = base + k, ends - length[items]
            full[items] = ends[-1] >= capacity - int(SLACK * capacity)
        return rows.select(["row", "length"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset)).append_column("full", pa.array(full))
    return pack


def place(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """row, length, sequence_id, offset of a written table of pieces (row, length; lengths 1 to ``capacity``).

    Results depend on the rows' numbers and lengths alone, so reruns agree.
    """
    ship_package(rows.sparkSession)
    left, parts, n = rows.select("row", "length"), [], rows.count()
    for turn in range(ROUNDS):
        groups = max(1, -(-n // group))
        dealt = left.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
        packed = written(dealt.groupBy("grp").applyInArrow(
            _packer(capacity, turn), "row long, length long, sequence_id long, offset long, full boolean"), f"pack-{turn}")
        rest = packed.where("NOT full")
        again = rest.count() if groups > 1 and turn + 1 < ROUNDS else 0
        if not again or 2 * again > n and again > group:
            return _all([*parts, packed.drop("full")])
        parts.append(packed.where("full").drop("full"))
        left, n = rest.select("row", "length"), again
    raise AssertionError("the last round packs all")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, keep_ids: bool = False, group: int = GROUP) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as it can.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset, with ``keep_ids`` also ids.

    A document is its text's ids and the end id; only longer ones are cut, every
    ``capacity`` tokens.  Null and empty texts are the end id alone.  Repeated
    rows, equal and null ids are documents of their own.  A very long text is
    split into words in one task; its pieces go apart.  An empty table gives no
    rows.  Columns besides doc_id and text are ignored whatever their names.
    """
    cut = written(pieces(docs, capacity, tokenizer, keep_ids), "pack-pieces")
    full = cut.where(F.col("length") == capacity)
    placed = place(written(cut.where(F.col("length") < capacity).select("row", "length"), "pack-rows"), capacity, group)
    placed = placed.drop("length").unionByName(full.select("row", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    extra = ["ids"] if keep_ids else []
    return cut.join(placed, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *extra)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, from ``pack(.., keep_ids=True)``; at most ``capacity`` ids a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
