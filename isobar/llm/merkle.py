"""Merkle dataset manifest with Octopus multiproofs.

Every row of a dataset is a leaf; the leaves of a source, in the order of their
ids, are the bottom of a tree in which 16 consecutive nodes have one parent;
the sources' roots are the leaves of one more tree.

Building: rows are range-partitioned in leaf order and packed into blocks of up
to ``BLOCK`` consecutive leaves, so a source may spread over any number of
tasks.  Sums of the blocks' counts give every block its place.  A block derives
all nodes that lie inside it and hands out only those whose parent does not;
the parents across blocks come from a few small Spark aggregations.

Proving: a block of leaves needs the siblings on its left and right edge alone,
at most 30 a level: the minimal union of missing coordinates of all its
leaves' proofs.  They are fetched once per block by a join, the block derives
the shared interior nodes, and expands every leaf's own proof from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map, bounded, written

FANOUT = 16
#: Leaves that a task expands at a time.
BLOCK = 4096
#: Columns of a row that its leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SHA = 32


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def parents(count: int) -> int:
    return -(-count // FANOUT)


def leaf_hash(values: list[Column]) -> Column:
    """Each value as ``-`` if null, else its UTF-8 length, a colon and itself."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def _pack(item: pa.DataType):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (tree, item, leaf, shown) rows to blocks of one tree, with their place in this task's run of the tree."""
        part, rest, tree, done = TaskContext.get().partitionId(), None, None, 0
        serial = part << 33
        for batch in _with_end(batches):
            rows = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if rows is None or not rows.num_rows:
                continue
            ids = rows.column("tree").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            edge = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)]
            start = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(edge[:-1], edge[1:])])
            end = np.minimum(np.repeat(edge[1:], -(-np.diff(edge) // BLOCK)), start + BLOCK)
            if batch is not None:  # the last block may go on in the next batch
                rest = rows.slice(int(start[-1]))
                start, end = start[:-1], end[:-1]
            if not len(start):
                continue
            column = rows.column("tree").combine_chunks()
            local = []
            for a, b in zip(start.tolist(), end.tolist()):
                now = (column[a].as_py(),)
                if now != tree:
                    tree, done = now, 0
                local.append(done)
                done += b - a
            m = int(end[-1])
            offsets = pa.array(np.r_[start, m].astype(np.int32))
            hashes = {}
            for c in ("leaf", "shown"):
                flat = rows.column(c).combine_chunks().slice(0, m)
                data = b"".join(flat.to_pylist())
                hashes[c] = pa.array([data[a * _SHA:b * _SHA] for a, b in zip(start.tolist(), end.tolist())], pa.binary())
            yield pa.RecordBatch.from_pydict({
                "tree": column.take(pa.array(start)), "block": pa.array(serial + np.arange(len(start))), "part": pa.array(np.full(len(start), part, np.int32)),
                "local": pa.array(np.array(local, np.int64)), "size": pa.array((end - start).astype(np.int64)),
                "items": pa.ListArray.from_arrays(offsets, rows.column("item").combine_chunks().slice(0, m).cast(item)), **hashes})
            serial += len(start)
    return pack


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """Blocks of the rows (tree, item, leaf, shown): tree, first, size, n (leaves of the tree), items, leaf, shown, block.

    ``leaf`` and ``shown`` are hex text.  Equal rows are told apart by where they were read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = {c: rows.schema[c].dataType for c in ("tree", "item")}
    keys = ["tree", "item", "leaf", "shown", "at"]
    ordered = (rows.withColumns({"leaf": F.unhex("leaf"), "shown": F.unhex("shown"), "at": F.monotonically_increasing_id()})
               .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("at"))
    blocks = written(arrow_map(ordered, _pack(to_arrow_type(kind["item"])),
                               f"tree {kind['tree'].simpleString()}, block long, part int, local long, size long, "
                               f"items array<{kind['item'].simpleString()}>, leaf binary, shown binary"), f"{name}-blocks")
    # one row per (tree, task); a tree's rows are as many as the tasks that hold some of it
    runs = blocks.groupBy("tree", "part").agg(F.sum("size").alias("run"))
    of_tree = Window.partitionBy("tree")
    runs = written(runs.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), F.sum("run").over(of_tree).alias("n"),
        (F.sum("run").over(of_tree.orderBy("part")) - F.col("run")).alias("before")), f"{name}-runs")
    width = F.octet_length(F.coalesce(F.col("t").cast("string"), F.lit(""))) + 24
    return (blocks.join(bounded(runs, width), F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
            .select("tree", "block", (F.col("before") + F.col("local")).alias("first"), "size", "n", "items", "leaf", "shown"))


def _hexes(data: bytes) -> list[str]:
    text = data.hex()
    return [text[i:i + 2 * _SHA] for i in range(0, len(text), 2 * _SHA)]


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that a block derives from its own leaves and whose parent it does not."""
    for batch in batches:
        out: dict[str, list] = {"at": [], "level": [], "idx": [], "n": [], "hash": []}
        first, size, total = (batch.column(c).to_pylist() for c in ("first", "size", "n"))
        for k, leaf in enumerate(batch.column("leaf").to_pylist()):
            low, high, n, level, nodes = first[k], first[k] + size[k], total[k], 0, _hexes(leaf)
            while low < high:
                lo, hi = (-(-low // FANOUT), parents(high) if high == n else high // FANOUT) if n > 1 else (0, 0)
                lo, hi = (lo, hi) if lo < hi else (0, 0)
                for i in (*range(low, min(high, lo * FANOUT)), *range(max(low, hi * FANOUT), high)) if lo < hi else range(low, high):
                    for c, v in zip(out, (k, level, i, n, nodes[i - low])):
                        out[c].append(v)
                nodes = [digest(nodes[j * FANOUT - low:min((j + 1) * FANOUT, high) - low]) for j in range(lo, hi)]
                low, high, n, level = lo, hi, parents(n), level + 1
        at = pa.array(out.pop("at"), pa.int64())
        yield pa.RecordBatch.from_pydict({
            "tree": batch.column("tree").take(at), "level": pa.array(out["level"], pa.int32()), "idx": pa.array(out["idx"], pa.int64()),
            "n": pa.array(out["n"], pa.int64()), "hash": pa.array(out["hash"], pa.string())})


def _nodes(blocks: DataFrame, name: str) -> DataFrame:
    """(tree, level, idx, n, hash): every node that no block holds whole, n being the nodes of its level."""
    kind = blocks.schema["tree"].dataType.simpleString()
    edge = written(arrow_map(blocks.select("tree", "first", "size", "n", "leaf"), _inside,
                             f"tree {kind}, level int, idx long, n long, hash string"), f"{name}-edges")
    most, level = blocks.agg(F.max("n")).first()[0] or 0, 0
    everything, built = edge, None
    while most > 1:
        here = edge.where((F.col("level") == level) & (F.col("n") > 1))
        if built is not None:
            here = here.unionByName(built.where("n > 1"))
        children = F.array_sort(F.collect_list(F.struct("idx", "hash")))  # 16 at most
        built = written(here.groupBy("tree", F.shiftright("idx", 4).alias("up"), "n").agg(children.alias("c")).select(
            "tree", F.lit(level + 1).alias("level"), F.col("up").alias("idx"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"),
            F.sha2(F.array_join(F.transform("c", lambda x: x["hash"]), ""), 256).alias("hash")), f"{name}-level")
        everything = everything.unionByName(built)
        most, level = parents(most), level + 1
    return everything


@dataclass
class Tree:
    """Leaves of one tree or several, in blocks, and the nodes across blocks."""

    blocks: DataFrame
    nodes: DataFrame

    @classmethod
    def of(cls, rows: DataFrame, name: str) -> Tree:
        blocks = _placed(rows, name)
        return cls(blocks, _nodes(blocks, name))

    def roots(self) -> DataFrame:
        """(tree, hash), one row per tree."""
        return self.nodes.where("n = 1").select("tree", "hash")

    def multiproofs(self) -> DataFrame:
        """blocks with ``fetched``: the nodes (level, idx, hash) that the block's leaves need and it cannot derive."""
        # level by level, what stands beside the nodes over the block, in their parents' runs
        spans = self.blocks.select("tree", "block", "first", (F.col("first") + F.col("size") - 1).alias("last"), "n")
        levels = F.filter(F.sequence(F.lit(0), F.lit(15)), lambda k: _level_size(F.col("n"), k) > 1)
        spans = spans.select("tree", "block", "first", "last", "n", F.explode(levels).alias("level"))
        low, high = F.expr("shiftright(first, level * 4)"), F.expr("shiftright(last, level * 4)")
        start = F.shiftleft(F.shiftright(low, 4), 4)
        stop = F.least(F.shiftleft(F.shiftright(high, 4) + 1, 4), _level_size(F.col("n"), F.col("level"))) - 1
        none = F.array().cast("array<long>")
        left = F.when(start < low, F.sequence(start, low - 1)).otherwise(none)
        right = F.when(high < stop, F.sequence(high + 1, stop)).otherwise(none)
        wanted = spans.select("tree", "block", "level", F.explode(F.concat(left, right)).alias("idx"))
        nodes = self.nodes.select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), "hash")
        met = wanted.join(nodes, F.col("tree").eqNullSafe(F.col("t")) & (F.col("level") == F.col("l")) & (F.col("idx") == F.col("i")))
        fetched = met.groupBy(F.col("block").alias("b")).agg(F.collect_list(F.struct("level", "idx", "hash")).alias("fetched"))
        return self.blocks.join(fetched, F.col("block") == F.col("b"), "left").drop("b")


def _level_size(n: Column, level: Column) -> Column:
    """Nodes of a level of a tree with n leaves."""
    return F.ceil(n / F.pow(F.lit(float(FANOUT)), level)).cast("long")


class Opened:
    """A block with its fetched nodes: the runs of siblings over its leaves, level by level."""

    def __init__(self, first: int, leaves: list[str], n: int, fetched: list[dict]):
        have = {(x["level"], x["idx"]): x["hash"] for x in fetched or ()}
        self.first, self.runs = first, []
        low, nodes, level = first, leaves, 0
        while n > 1:
            high = low + len(nodes)
            base = low // FANOUT * FANOUT
            stop = min(parents(high) * FANOUT, n)
            run = [have[level, i] for i in range(base, low)] + nodes + [have[level, i] for i in range(high, stop)]
            self.runs.append((base, run))
            nodes = [digest(run[j:j + FANOUT]) for j in range(0, len(run), FANOUT)]
            low, n, level = base // FANOUT, parents(n), level + 1
        self.root = nodes[0]

    def beside(self, at: int, level: int) -> tuple[str, str]:
        """The siblings before and after the node ``at`` of a level."""
        base, run = self.runs[level]
        i = at - base
        j = i // FANOUT * FANOUT
        return "".join(run[j:i]), "".join(run[i + 1:j + FANOUT])

    def path(self, at: int, level: int = 0) -> list[tuple[str, str]]:
        """From the node ``at`` of a level: the siblings of all nodes on the way to the root."""
        return [self.beside(at >> 4 * k, level + k) for k in range(len(self.runs) - level)]


def fold(node: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        node = digest([before, node, after])
    return node


_PATH = "array<struct<before:string,after:string>>"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf of the blocks with its own proof."""
    for batch in batches:
        for r in batch.to_pylist():
            leaves = _hexes(r["leaf"])
            opened = Opened(r["first"], leaves, r["n"], r["fetched"])
            rows = [{"item": x, "leaf": leaf, "root": opened.root, "path": [{"before": b, "after": a} for b, a in opened.path(r["first"] + i)]}
                    for i, (x, leaf) in enumerate(zip(r["items"], leaves))]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("item", batch.schema.field("items").type.value_type), ("leaf", pa.string()), ("root", pa.string()),
                ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))]))


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            r = {c: batch.column(c)[k].as_py() for c in ("first", "n", "leaf", "shown", "fetched", "root", "path")}
            leaves, shown = _hexes(r["leaf"]), _hexes(r["shown"])
            opened = Opened(r["first"], leaves, r["n"], r["fetched"])
            over = [(x["before"], x["after"]) for x in r["path"] or ()]
            # what leaves under one parent share of their proofs
            shared = {}
            proofs, folded = [], []
            for i, leaf in enumerate(shown):
                at = r["first"] + i
                mine = [opened.beside(at, 0)] if opened.runs else []
                up = at // FANOUT
                if up not in shared:
                    rest = [*opened.path(up, 1), *over] if opened.runs else over
                    shared[up] = rest, "".join(b + a for b, a in rest)
                rest, text = shared[up]
                proofs.append(digest([b + a for b, a in mine] + [text]))
                folded.append(fold(leaf, [*mine, *rest]))
            n = len(leaves)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("items")[k].values, "leaf": pa.array(leaves, pa.string()),
                "subroot": pa.array([opened.root] * n), "root": pa.array([r["root"]] * n), "proof_sha256": pa.array(proofs),
                "folded_root": pa.array(folded), "verified": pa.array([f == r["root"] for f in folded])})


class Manifest:
    """The trees of a dataset: ``leaves`` (one tree per source) and ``sources`` (one tree over their roots)."""

    def __init__(self, docs: DataFrame, tampered: Column | None = None):
        """``tampered``: the leaf that a row shows instead of its own (hex text)."""
        leaf = leaf_hash([F.col(c) for c in FIELDS])
        shown = leaf if tampered is None else F.coalesce(tampered, leaf)
        # written, as the range partitioning reads its input twice
        rows = written(docs.select(F.col("source").alias("tree"), F.col("doc_id").alias("item"), leaf.alias("leaf"), shown.alias("shown")), "merkle-leaves")
        self.leaves = Tree.of(rows, "merkle")
        tops = self.leaves.roots().select(F.lit(0).alias("tree"), F.col("tree").alias("item"), F.col("hash").alias("leaf"), F.col("hash").alias("shown"))
        self.sources = Tree.of(tops, "merkle-sources")

    def source_proofs(self) -> DataFrame:
        """(item, leaf, root, path): every source with its subroot, the dataset's root and the proof between them."""
        kind = self.sources.blocks.schema["items"].dataType.elementType.simpleString()
        return arrow_map(self.sources.multiproofs().select("first", "n", "items", "leaf", "fetched"), _paths,
                         f"item {kind}, leaf string, root string, path {_PATH}")

    def audit(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the shown leaf) and verified of every leaf."""
        kind = self.leaves.blocks.schema["items"].dataType.elementType.simpleString()
        proofs = written(self.source_proofs().select(F.col("item").alias("s"), "root", "path"), "merkle-source-proofs")
        width = F.octet_length(F.coalesce(F.col("s").cast("string"), F.lit(""))) + 1100 * (F.size("path") + 1)
        blocks = self.leaves.multiproofs().join(bounded(proofs, width), F.col("tree").eqNullSafe(F.col("s")))
        return arrow_map(blocks.select("first", "n", "items", "leaf", "shown", "fetched", "root", "path"), _audit,
                         f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


LOWERED = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame, every: int = 5) -> DataFrame:
    """Build the manifest of docs, tamper with some rows, and verify every row by its proof.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.
    Rows whose crc32(doc_id) is divisible by ``every`` show a text in lower case.

    Nulls are values of their own in a leaf; the null source is a tree and comes
    first; rows with a null id come first and are not tampered with.  Rows with
    one id are ordered by their leaf; equal rows are leaves of their own.  Empty
    texts count as texts; texts of any length are only hashed, by the JVM.  An
    empty table gives no rows.  Other columns are ignored whatever their names.
    """
    chosen = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(every)) == 0
    fields = [F.translate("text", *LOWERED) if c == "text" else F.col(c) for c in FIELDS]
    return Manifest(docs, F.when(chosen, leaf_hash(fields))).audit()
