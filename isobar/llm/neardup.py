"""Near-duplicate groups by a chosen-path set similarity join.

A document's set holds its distinct word shingles.  Documents with equal sets
form one class, and one set stands for it.  Classes are dealt down random
trees: a node chooses one or two coordinates of the minwise signature (1 / J of
them on average, J the similarity sought), and for each a class goes to the
child of its value there.  Similar sets keep meeting: each level a pair of
similarity J shares one child on average, and below the first level a little
more than one, so that deep trees lose hardly more pairs than shallow ones.  Spark deals the classes down until a
node fits a task, which branches on; nodes of a few classes are compared
exhaustively, and a node whose classes are all tied together is done.
Independent trees repeat this until pairs that miss each other in all of them
are negligible.

Sketches of the signatures decide which comparisons matter; every link is then
confirmed on the full sets.  A family (classes joined by likely links) is sent
to one task and linked exactly there, pivot against all, without listing
pairs.  Families too large for that are joined by prefixes: two sets of
similarity J share an element among the first 1 - J of each in any one order, so
sets that share none of their rarest elements need no comparison, and those that
do are compared, block against block where they are many.  No link inside a
family is lost either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map, fresh, join_rows, row_key, written
from isobar.llm.components import components
from isobar.llm.words import SPACED, Hasher, Piece, mix, pieces

SHINGLE, PERCENT = 5, 80
#: Independent trees; levels dealt out by Spark, and the levels a task adds below them.
TREES, LEVELS, DEPTH = 16, 8, 12
#: Children that a pair at the threshold shares on average, at each level but the first.
GROWTH = 1.1
#: Classes in a node that one task takes, and in a node that is compared exhaustively.
NODE, LEAF = 8192, 64
#: Signature coordinates; deviations below the threshold that a sketch may show.
COORDINATES, DEVIATIONS = 96, 6.0
#: Pivot sweeps times set elements that one task may do for a family (about a nanosecond each).
FAMILY_WORK = 2e10
#: Set elements that one task may hold for a family (8 bytes each, and a few copies).
FAMILY_ELEMENTS = 1 << 24
PIVOTS = 8
#: Counters of the elements of the families too large for one task, from which their rarest are told.
COUNTERS = 1 << 18
U64 = np.uint64
_R = np.random.default_rng(314159)
_MULTIPLIERS = _R.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)
_ADDENDS = _R.integers(1, 1 << 62, COORDINATES, dtype=np.uint64)


def shingle_sets(p: Piece, hasher: Hasher, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; short texts have one, empty texts none."""
    h = hasher.ranges(p.data, p.start, p.end)
    full = hasher.windows(h, k)
    out = []
    for i in range(p.n_texts):
        a, b = int(p.word0[i]), int(p.word0[i + 1])
        if b - a >= k:
            s = np.sort(full[a:b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mix(hasher.windows(h[a:b], b - a) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """Minwise values of a set, one 32-bit value per coordinate."""
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(s), 4096):
        part = ((s[at:at + 4096][None, :] * _MULTIPLIERS[:, None] + _ADDENDS[:, None]) >> U64(32)).min(axis=1)
        out = np.minimum(out, part.astype(np.uint32))
    return out


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(99, lower=True)
        for batch in batches:
            n = batch.num_rows
            size, f1, f2, mins = np.zeros(n, np.int64), np.zeros(n, U64), np.zeros(n, U64), []
            for p in pieces(batch.column("text"), SPACED):
                for i, s in enumerate(shingle_sets(p, hasher, k), p.first):
                    size[i] = len(s)
                    f1[i], f2[i] = mix(s).sum(), mix(s ^ U64(0x5851F42D4C957F2D)).sum()
                    mins.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(size), pa.array(f1.view(np.int64)),
                 pa.array(f2.view(np.int64)), pa.array(mins, pa.binary())],
                ["doc_id", "row_key", "n_shingles", "f1", "f2", "mins"])
    return run


def second_choice(percent: int, growth: float = GROWTH) -> float:
    """How often a node chooses two coordinates."""
    return min(1.0, max(0.0, growth * 100 / percent - 1))


def _children(percent: int, trees: int | None) -> Callable:
    """Rows (node, cid, mins) to rows (node, cid) one level down; ``trees`` starts them at the roots."""
    second = U64(int(second_choice(percent, GROWTH if trees is None else 1.0) * (1 << 32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            mins = np.frombuffer(b"".join(batch.column("mins").to_pylist()), np.uint32).reshape(n, COORDINATES)
            cid = batch.column("cid").to_numpy()
            if trees is None:
                parents = [batch.column("node").to_numpy().view(U64)]
            else:
                parents = [np.full(n, mix(np.array([t + 1], U64))[0], U64) for t in range(trees)]
            nodes, cids = [], []
            for node in parents:
                draw = mix(node + U64(0x632BE59BD9B4E019))
                for turn in range(2):
                    take = np.ones(n, bool) if turn == 0 else (draw >> U64(32)) < second
                    at = ((draw + U64(turn * 37)) % U64(COORDINATES)).astype(np.int64)[take]
                    value = mins[take, at].astype(U64)
                    nodes.append(mix(node[take] * U64(0x9E3779B97F4A7C15) + (value << U64(8)) + at.astype(U64)))
                    cids.append(cid[take])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes).view(np.int64)), pa.array(np.concatenate(cids))],
                                             ["node", "cid"])
    return run


class Groups:
    """Members' groups in one node: ``root`` has the first member of each one's group."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def tie(self, x: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[x]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]


def _likely(size: np.ndarray, sketch: np.ndarray, x: int, others: np.ndarray, percent: int, floor: float) -> np.ndarray:
    """Those of ``others`` that x may be linked with, by size and sketch."""
    s = size[others]
    others = others[100 * np.minimum(s, size[x]) >= percent * np.maximum(s, size[x])]
    share = (sketch[others] == sketch[x]).mean(axis=1)
    return others[(share - 1 / 256) / (1 - 1 / 256) >= floor]


def node_groups(size: np.ndarray, sketch: np.ndarray, percent: int, floor: float, seed: int, small: int) -> np.ndarray:
    """Root of each member's group after the tree below this node.

    A node first ties one member to all that are like it, and is done when all
    its members are tied.  Otherwise it branches by a coordinate or two, or, if
    it is small or deep, compares every member with those not tied to it yet.
    """
    groups = Groups(len(size))
    second = int(second_choice(percent) * (1 << 32))
    todo = [(np.arange(len(size)), seed & 0xFFFFFFFFFFFFFFFF, 0)]
    while todo:
        at, node, depth = todo.pop()
        draw = int(mix(np.array([(node + depth) & 0xFFFFFFFFFFFFFFFF], U64))[0])
        pivot = int(at[draw % len(at)])
        rest = at[groups.root[at] != groups.root[pivot]]
        if len(rest):
            groups.tie(pivot, _likely(size, sketch, pivot, rest, percent, floor))
        if (groups.root[at] == groups.root[at[0]]).all():
            continue
        if len(at) <= small or depth >= DEPTH:
            for i, x in enumerate(at[:-1].tolist()):
                rest = at[i + 1:]
                rest = rest[groups.root[rest] != groups.root[x]]
                if len(rest):
                    groups.tie(x, _likely(size, sketch, x, rest, percent, floor))
            continue
        for turn in range(1 + ((draw >> 32) < second)):
            c = (draw + 37 * turn) % COORDINATES
            order = at[np.argsort(sketch[at, c], kind="stable")]
            cuts = np.flatnonzero(np.diff(sketch[order, c])) + 1
            todo += [(part, draw ^ (int(sketch[part[0], c]) << 8) ^ c, depth + 1)
                     for part in np.split(order, cuts) if len(part) > 1]
    return groups.root


def _leaf_edges(percent: int, small: int):
    j = percent / 100
    floor = j - DEVIATIONS * np.sqrt(j * (1 - j) / COORDINATES)

    def tied(node: int, parts: list[tuple]) -> pa.RecordBatch:
        cids, size, sk = (np.concatenate(x) for x in zip(*parts))
        root = node_groups(size, sk, percent, floor, node, small)
        m = root != np.arange(len(cids))
        return pa.RecordBatch.from_arrays([pa.array(cids[m]), pa.array(cids[root[m]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by node; a task holds one node and one batch at a time
        node, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column("node").to_numpy()
            cids, size = batch.column("cid").to_numpy(), batch.column("n_shingles").to_numpy()
            sk = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(len(cids), COORDINATES)
            first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
            done = []
            for x, y in zip(first.tolist(), [*first[1:].tolist(), len(nodes)]):
                if nodes[x] != node:
                    if parts:
                        done.append(tied(node, parts))
                    node, parts = int(nodes[x]), []
                parts.append((cids[x:y], size[x:y], sk[x:y]))
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if parts:
            yield tied(node, parts)
    return run


def link_sets(sets: list[np.ndarray], percent: int, known: np.ndarray) -> np.ndarray:
    """For each set the first set that exact links connect it with.

    Pivot by pivot, against all sets at once; pairs already connected need no
    look, nor do those of equal ``known``.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(ids.max()) + 1, np.int64) if len(ids) else np.zeros(1, np.int64)
    groups = Groups(n)
    _, first, at = np.unique(known, return_index=True, return_inverse=True)
    groups.root = first[at]
    for x in range(n - 1):
        todo = groups.root != groups.root[x]
        todo[:x + 1] = False
        todo &= (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
        if not todo.any():
            if not groups.root.any():
                break
            continue
        mine = ids[bounds[x]:bounds[x + 1]]
        mark[mine] = 1
        if todo.sum() * 8 < n:
            both = np.zeros(n, np.int64)
            for y in np.flatnonzero(todo).tolist():
                both[y] = mark[ids[bounds[y]:bounds[y + 1]]].sum()
        else:
            both = np.add.reduceat(mark[ids], bounds[:-1])
        mark[mine] = 0
        linked = np.flatnonzero(todo & (100 * both >= percent * (size + size[x] - both)))
        if len(linked):
            groups.tie(x, linked)
    return groups.root


def _grouped(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(cids, known roots, sets) of each run of equal ``family``, across batches."""
    family, cids, known, sets = None, [], [], []
    for batch in rows:
        for f, c, k, s in zip(*(batch.column(name).to_pylist() for name in ("family", "cid", "known", "set"))):
            if f != family:
                if cids:
                    yield np.array(cids), np.array(known), sets
                family, cids, known, sets = f, [], [], []
            if not cids or c != cids[-1]:  # a class may have come with several rows
                cids.append(c)
                known.append(k)
                sets.append(np.frombuffer(s, U64))
    if cids:
        yield np.array(cids), np.array(known), sets


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b, held = [], [], 0
        for cids, known, sets in _grouped(batches):
            root = link_sets(sets, percent, known)
            tied = np.zeros(len(cids), bool)
            tied[np.unique(known, return_index=True)[1]] = True  # one link for all of a known group
            tied &= root != np.arange(len(cids))
            out_a.append(cids[tied])
            out_b.append(cids[root[tied]])
            held += int(tied.sum())
            if held > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
                out_a, out_b, held = [], [], 0
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(99, lower=True)
        for batch in batches:
            at = 0
            for p in pieces(batch.column("text"), SPACED):
                sets = pa.array([s.tobytes() for s in shingle_sets(p, hasher, k)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("cid").slice(at, p.n_texts), sets], ["cid", "set"])
                at += p.n_texts
    return run


def _nodes(classes: DataFrame, percent: int, trees: int, levels: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """(leaf rows, rows of nodes still larger at the last level), both (node, cid)."""
    leaves, rows = [], arrow_map(classes.select("cid", "mins"), _children(percent, trees), "node long, cid long")
    for level in range(levels):
        rows = written(rows, f"nodes-{level}")
        # written, so that Spark can split a large node's rows in the join
        sizes = written(rows.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > 1), f"nodes-sizes-{level}")
        sized = written(rows.join(sizes, "node"), f"nodes-sized-{level}")
        leaves.append(sized.where(F.col("n") <= leaf).select("node", "cid"))
        large = sized.where(F.col("n") > leaf).select("node", "cid")
        if level == levels - 1 or large.isEmpty():
            break
        rows = arrow_map(large.join(classes.select("cid", "mins"), "cid").select("node", "cid", "mins"),
                         _children(percent, None), "node long, cid long")
    out = leaves[0]
    for x in leaves[1:]:
        out = out.unionByName(x)
    return out, large


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, trees: int = TREES,
                    levels: int = LEVELS, node: int = NODE, leaf: int = LEAF, family_work: float = FAMILY_WORK,
                    family_elements: int = FAMILY_ELEMENTS) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, group_id and kept of every row.

    Two documents are linked if 100 * shared shingles >= percent * all shingles.
    Texts of fewer words than a shingle have one shingle, the whole sequence;
    null and empty texts have none and are linked with nothing.  component_id
    is the smallest id in the component (null if none of it has an id); kept
    marks the rows whose id it is.  group_id numbers the components of one run
    (null for texts without words).  Repeated rows are linked as equal sets.
    Empty tables give an empty result.

    Pairs at the threshold are found by each tree with a chance of about 0.87
    where one level separates strangers, so 16 trees lose fewer than 1 in 1e12.
    Deeper nodes lose more, counted over Spark's levels and the task's: at
    percent 85 the chance is 0.57 at 8 levels and 0.47 at 20 (LEVELS + DEPTH),
    so 16 trees lose 1 and 37 in a million; at percent 80 it is 0.51 and 0.42,
    and 16 trees lose 10 and 180 in a million.  Nodes still mixed at the last level
    are compared exhaustively.  That is for pairs that no other link or
    pivot connects.  Within a family no link at all
    is lost, whatever its size.
    """
    slim = docs.select("doc_id", row_key(F.col("text")).alias("row_key"), "text")
    rows = written(arrow_map(slim, _signed(shingle), "doc_id long, row_key long, n_shingles long, f1 long, f2 long, mins binary"), "sets")
    # one class per distinct set; ids are numbered in a written table, so they stay
    classes = written(rows.where(F.col("n_shingles") > 0).groupBy("f1", "f2", "n_shingles")
                      .agg(F.min("doc_id").alias("first"), F.min_by(F.struct("doc_id", "row_key", "mins"), F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("r"))
                      .select("f1", "f2", "n_shingles", "first", F.col("r.doc_id").alias("doc_id"), F.col("r.row_key").alias("row_key"),
                              F.col("r.mins").alias("mins"), F.monotonically_increasing_id().alias("cid")), "classes")
    leaves, large = _nodes(classes, percent, trees, levels, node)

    # likely links: below the nodes a task takes, by sketch; a node that stays large is one family
    sketch = classes.select("cid", "n_shingles", F.col("mins").alias("sketch"))
    low_bytes = arrow_map(sketch, _low_bytes, "cid long, n_shingles long, sketch binary")
    members = (leaves.join(written(low_bytes, "sketches"), "cid").select("node", "cid", "n_shingles", "sketch")
               .repartition("node").sortWithinPartitions("node", "cid"))  # at most ``node`` rows each
    likely = arrow_map(members, _leaf_edges(percent, leaf), "a long, b long")
    star = large.join(written(large.groupBy("node").agg(F.min("cid").alias("b")), "nodes-first"), "node").select(F.col("cid").alias("a"), "b")
    family = written(components(likely.unionByName(star)), "families")

    # exact links inside families
    sized = family.join(classes.select("cid", "n_shingles"), F.col("node") == F.col("cid"))
    work = written(sized.groupBy("root").agg((F.count("*") * F.sum("n_shingles")).cast("double").alias("work"), F.sum("n_shingles").alias("elements")), "family-work")
    fit = (F.col("work") <= family_work) & (F.col("elements") <= family_elements)
    wanted = written(family.join(classes.select("cid", "doc_id", "row_key"), F.col("node") == F.col("cid"))
                     .select("doc_id", "row_key", "cid"), "family-rows")
    texts = join_rows(slim, wanted, "inner", F.lit(40))
    sets = written(arrow_map(texts.select("cid", "text"), _sets(shingle), "cid long, set binary"), "family-sets")
    fits = family.join(work.where(fit), "root").select(F.col("node").alias("cid"), F.col("root").alias("family"))
    links = _exact(fits, sets, percent)
    too_large = work.where(~fit)
    if too_large.isEmpty():
        root = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    else:  # their links come from several tasks and have yet to be joined
        root = components(links.unionByName(_exact_by_prefix(family, too_large, sets, percent, node, family_work, family_elements)))
    root = written(root, "class-roots")
    ids = classes.select("cid", "f1", "f2", "first").join(root, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    grouped = ids.groupBy("root").agg(F.min("first").alias("component_id"))
    names = ids.select("f1", "f2", "root").join(grouped, "root").select("f1", "f2", "component_id", F.col("root").alias("group_id"))
    result = ["doc_id", "row_key", "n_shingles", "component_id", "group_id"]
    linked = rows.where(F.col("n_shingles") > 0).join(written(names, "class-components"), ["f1", "f2"]).select(*result)
    alone = rows.where(F.col("n_shingles") == 0).select(
        "doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs, one of each component: that of its smallest id.

    Of rows that agree in id and text one stays; texts without words all stay.
    """
    by_id = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    found = written(found.select("doc_id", "row_key", "group_id"), "near-groups")
    n = fresh(docs, "n")
    first = (found.where(F.col("group_id").isNotNull()).groupBy("group_id", "doc_id", "row_key").agg(F.count("*").alias(n))
             .groupBy("group_id").agg(F.min_by(F.struct("doc_id", "row_key", n), by_id).alias("r"))
             .select("r.doc_id", "r.row_key", f"r.{n}"))
    empty = found.where(F.col("group_id").isNull()).select("doc_id", "row_key", F.lit(1).cast("long").alias(n)).distinct()
    stays = join_rows(docs, written(first.unionByName(empty), "near-kept"), "inner", F.lit(40))
    again = stays.where(F.col(n) > 1).dropDuplicates(["doc_id", "text"])
    return stays.where(F.col(n) == 1).unionByName(again).drop(n)


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = [np.frombuffer(m, np.uint32).astype(np.uint8).tobytes() for m in batch.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("n_shingles"), pa.array(low, pa.binary())], batch.schema.names)


def _exact(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) inside each group: b is the least class that links connect a with.

    ``groups`` has rows (cid, family), and ``known`` where classes are linked already.
    """
    if "known" not in groups.columns:
        groups = groups.withColumn("known", F.col("cid"))
    rows = groups.join(sets, "cid").repartition("family").sortWithinPartitions("family", "cid")
    return arrow_map(rows.select("family", "cid", "known", "set"), _confirm(percent), "a long, b long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for s in batch.column("set").to_pylist():
            np.add.at(total, (np.frombuffer(s, U64) % U64(COUNTERS)).astype(np.int64), 1)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], ["slot", "n"])


def _prefixes(percent: int, counts) -> Callable:
    """Rows (cid, known, set) to a row (element, cid, known, size) for each element of the set's prefix.

    Linked sets share at least percent of either's elements, so they share one
    of the first size - ceil(percent of size) + 1 of each, in any one order: here
    that of the counters, so that the first are rare.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counts.value
        for batch in batches:
            out = []
            for s in batch.column("set").to_pylist():
                s = np.frombuffer(s, U64)
                order = np.lexsort((s, total[(s % U64(COUNTERS)).astype(np.int64)]))
                out.append(s[order[:len(s) + (-percent * len(s)) // 100 + 1]])
            if not out:
                continue
            n = np.array([len(x) for x in out])
            size = np.array([len(x) // 8 for x in batch.column("set").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(batch.column("cid").to_numpy(), n)),
                 pa.array(np.repeat(batch.column("known").to_numpy(), n)), pa.array(np.repeat(size, n))],
                ["element", "cid", "known", "size"])
    return run


def _blocks(n: str, size: str, block: int, family_work: float, family_elements: float):
    """Blocks for ``n`` classes of ``size`` elements in all, so that each fits a task."""
    by_work = F.ceil(F.sqrt(F.col(n).cast("double") * F.col(size) / family_work))
    by_size = F.ceil(F.col(size) / family_elements)
    return F.least(F.col(n), F.greatest(F.ceil(F.col(n) / block), by_work, by_size)).cast("int")


def _exact_by_prefix(family: DataFrame, work: DataFrame, sets: DataFrame, percent: int, block: int, family_work: float,
                     family_elements: int) -> DataFrame:
    """All links of the families too large for one task, up to links that others imply.

    A first pass deals each family into blocks that share its pivots (those of
    least hash).  The second compares all classes that share a prefix element
    and are not linked yet.  Where they are too many for a task, those outside
    the largest linked group are compared with all, block against block.
    """
    mine = family.join(work.select("root"), "root").select(F.col("node").alias("cid"), "root")
    mine = written(mine.join(sets, "cid").dropDuplicates(["cid"]), "large-sets")
    own = mine.select("cid", "set")
    rows = mine.select("cid", "root", (F.length("set") / 8).cast("long").alias("size"))
    pivots = written(rows.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("size"), *[
        F.min_by("cid", F.xxhash64(F.lit(i), F.col("cid"))).alias(f"p{i}") for i in range(PIVOTS)])
        .withColumn("blocks", _blocks("n", "size", block, family_work, family_elements)), "large-pivots")
    dealt = rows.select("cid", "root").join(pivots.select("root", "blocks"), "root").select(
        "cid", F.xxhash64("root", F.pmod(F.xxhash64("cid", "root"), F.col("blocks")).cast("int")).alias("family"))
    tie = pivots.select("root", "blocks", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("cid")).select(
        "cid", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.xxhash64("root", b))).alias("family"))
    first = written(_exact(dealt.unionByName(tie).distinct(), own, percent), "large-links")

    # prefixes, with the group that the first pass found
    total = np.zeros(COUNTERS, np.int64)
    for slot, n in arrow_map(own.select("set"), _counted, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():  # COUNTERS rows at most
        total[slot] = n
    counts = family.sparkSession.sparkContext.broadcast(total)
    roots = written(components(first).select(F.col("node").alias("cid"), F.col("root").alias("known")), "large-roots")
    known = own.join(roots, "cid", "left").select("cid", F.coalesce("known", "cid").alias("known"), "set")
    held = written(arrow_map(known, _prefixes(percent, counts), "element long, cid long, known long, size long"), "prefixes")
    per_root = held.groupBy("element", "known").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"),
        *[F.bit_xor(F.xxhash64(F.lit(i), F.col("cid"))).alias(f"x{i}") for i in range(2)])
    groups = per_root.groupBy("element").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max("n").alias("n_main"),
        F.max_by(F.struct("known", "size"), F.struct("n", "known")).alias("main"), *[F.bit_xor(x).alias(x) for x in ("x0", "x1")])
    # elements of the same classes need one look
    groups = (groups.where(F.col("parts") > 1).groupBy("n", "x0", "x1")
              .agg(F.min_by(F.struct("element", "size", "n_main", "main"), "element").alias("r"))
              .select("r.element", "n", "r.size", "r.n_main", F.col("r.main.known").alias("main"), F.col("r.main.size").alias("size_main")))
    groups = (groups.withColumn("n_rest", F.col("n") - F.col("n_main")).withColumn("size_rest", F.col("size") - F.col("size_main"))
              .withColumn("whole", _blocks("n", "size", block, family_work, family_elements) == 1))
    half, quarter, elements = max(block // 2, 1), family_work / 4, family_elements / 2  # two blocks meet in a task
    groups = written(groups.withColumn("b_main", _blocks("n_main", "size_main", half, quarter, elements))
                     .withColumn("b_rest", _blocks("n_rest", "size_rest", half, quarter, elements))
                     .select("element", "main", "whole", "b_main", "b_rest"), "prefix-groups")
    live = written(held.select("element", "cid", "known").join(groups, "element"), "prefix-rows")
    small = live.where("whole").select("cid", "known", F.xxhash64("element").alias("family"))
    large = live.where(~F.col("whole"))
    main, rest = large.where(F.col("known") == F.col("main")), large.where(F.col("known") != F.col("main"))

    def each(n: str, key: Callable) -> DataFrame:
        return F.explode(F.transform(F.sequence(F.lit(0), F.col(n) - 1), key)).alias("family")

    def at(n: str):
        return F.pmod(F.xxhash64("cid", "element"), F.col(n)).cast("int")
    cross = [main.select("cid", "known", each("b_rest", lambda i: F.xxhash64("element", i, at("b_main"), F.lit(0)))),
             rest.select("cid", "known", each("b_main", lambda i: F.xxhash64("element", at("b_rest"), i, F.lit(0)))),
             rest.select("cid", "known", each("b_rest", lambda i: F.xxhash64("element", F.least(i, at("b_rest")), F.greatest(i, at("b_rest")), F.lit(1))))]
    for x in cross:
        small = small.unionByName(x)
    return first.unionByName(_exact(small, own, percent))
