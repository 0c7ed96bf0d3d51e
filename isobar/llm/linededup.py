"""Line dedup over levelled sorted runs of line hashes.

A run holds one entry per line key: in how many documents the key has been
seen, and the largest id among them.  Each batch of documents becomes a sorted
run of its own.  It is merge-joined with the runs before it: keys they do not
have (the anti-join) enter as they are, keys they have enter with the summed
counts, so that the newest entry of a key is the true one.  When a level has
``FANOUT`` runs they are compacted into one run of the next level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import BROADCAST_BYTES, arrow_map, written

SPACE = " \t\n\x0b\x0c\r"
MIN_LENGTH, MIN_DOCS = 40, 5
BATCHES, FANOUT = 4, 2

_PAIRS = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64())]))
PAIRS = "array<struct<hi:long,lo:long>>"


def line_key(line: str, min_length: int = MIN_LENGTH) -> tuple[int, int] | None:
    """128-bit hash of the stripped line with A-Z lower-cased; None if it is too short."""
    line = line.strip(SPACE)
    if len(line) < min_length:
        return None
    d = hashlib.blake2b(line.encode().lower(), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def line_keys(docs: DataFrame, batches: int = BATCHES, min_length: int = MIN_LENGTH) -> DataFrame:
    """(batch, doc_id, hi, lo) for each distinct long line of each row; an id's rows share a batch."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys = []
            for text in batch.column("text").to_pylist():
                found = {line_key(x, min_length) for x in (text or "").split("\n") if len(x) >= min_length}
                keys.append([{"hi": k[0], "lo": k[1]} for k in found if k])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, _PAIRS)], ["doc_id", "keys"])

    found = arrow_map(docs.select("doc_id", "text"), run, f"doc_id long, keys {PAIRS}")
    return (found.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
                         F.explode("keys").alias("k")).select("batch", "doc_id", "k.hi", "k.lo"))


class LineRuns:
    """The levelled runs; every run is a written table sorted by key."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.version = spark, fanout, 0
        self.levels: list[list[DataFrame]] = []

    def _runs(self) -> DataFrame | None:
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    def current(self) -> DataFrame | None:
        """The newest entry of every key over all runs."""
        runs = self._runs()
        if runs is None:
            return None
        return (runs.groupBy("hi", "lo").agg(F.max(F.struct("version", "n_docs", "max_doc")).alias("e"))
                .select("hi", "lo", "e.version", "e.n_docs", "e.max_doc"))

    def _write(self, run: DataFrame, level: int) -> None:
        # sorted within the hash partitions of the join or aggregate that made it
        table = written(run.select("hi", "lo", "version", "n_docs", "max_doc").sortWithinPartitions("hi", "lo"), f"line-run-{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)

    def add(self, keys: DataFrame) -> None:
        """Add a batch: distinct (doc_id, hi, lo) of documents not added before."""
        self.version += 1
        fresh = (keys.dropDuplicates(["hi", "lo", "doc_id"]).groupBy("hi", "lo")
                 .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc")))
        known = self.current()
        if known is None:
            merged = fresh
        else:
            old = known.select("hi", "lo", F.col("n_docs").alias("o_docs"), F.col("max_doc").alias("o_max"))
            merged = fresh.join(old, ["hi", "lo"], "left").select(
                "hi", "lo", (F.col("n_docs") + F.coalesce("o_docs", F.lit(0))).alias("n_docs"),
                F.greatest("max_doc", "o_max").alias("max_doc"))
        self._write(merged.withColumn("version", F.lit(self.version)), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """Merge all runs of a level into one run of the next."""
        merged = LineRuns(self.spark)
        merged.levels = [self.levels[level]]
        run = merged.current()
        self.levels[level] = []
        self._write(run, level + 1)


def _lookup(hi: np.ndarray, lo: np.ndarray, keys: list[tuple[int, int]]) -> list[int]:
    """Index of each key in the arrays sorted by (hi, lo), or -1."""
    want = np.array(keys, np.int64).reshape(-1, 2)
    a, b = np.searchsorted(hi, want[:, 0]), np.searchsorted(hi, want[:, 0], side="right")
    return [next((i for i in range(x, y) if lo[i] == k[1]), -1) for x, y, k in zip(a.tolist(), b.tolist(), keys)]


def _drop_lines(batches: Iterator[pa.RecordBatch], frequent: Broadcast | None, min_length: int,
                with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = [(t or "").split("\n") for t in batch.column("text").to_pylist()]
        keys = [[line_key(x, min_length) if len(x) >= min_length else None for x in t] for t in texts]
        if frequent is not None:
            hi, lo, top, has_top = frequent.value
            flat = list({k for ks in keys for k in ks if k})
            at = dict(zip(flat, _lookup(hi, lo, flat)))

            def dropped(doc, k):
                i = at[k]
                return i >= 0 and bool(has_top[i]) and (doc is None or doc != top[i])
            drop = [{k for k in ks if k and dropped(doc, k)} for doc, ks in zip(ids, keys)]
        else:
            drop = [{(x["hi"], x["lo"]) for x in ks or ()} for ks in batch.column("drops").to_pylist()]
        kept = [[x for x, k in zip(t, ks) if k is None or k not in d] for t, ks, d in zip(texts, keys, drop)]
        whole = ["\n".join(t) for t in kept]
        out = [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
               pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
               pa.array([hashlib.sha256(t.encode()).hexdigest() for t in whole], pa.string())]
        names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
        if with_text:
            out.append(pa.array(whole, pa.string()))
            names.append("kept_text")
        yield pa.RecordBatch.from_arrays(out, names)


def drop_repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES,
                        with_text: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (and kept_text) of every row.

    Lines whose key has ``min_length`` code points or more and is found in
    ``min_docs`` documents lose all their lines except in the largest doc_id.
    Rows that share an id are one document.  Null ids are one document, smaller
    than any other.  Null or empty text is one empty line.  An empty table
    gives an empty result.

    The frequent keys reach the tasks by broadcast while their measured size
    is within ``broadcast_bytes``, and by a shuffle join beyond it.
    """
    spark = docs.sparkSession
    keys = written(line_keys(docs, batches, min_length), "line-keys")
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b))
    frequent = written(runs.current().where(F.col("n_docs") >= min_docs).select("hi", "lo", "max_doc"), "line-frequent")
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * with_text
    if frequent.count() * 32 <= broadcast_bytes:
        rows = frequent.toPandas().sort_values(["hi", "lo"])  # within broadcast_bytes
        shared = spark.sparkContext.broadcast((rows.hi.to_numpy(np.int64), rows.lo.to_numpy(np.int64),
                                               rows.max_doc.fillna(0).to_numpy(np.int64), rows.max_doc.notna().to_numpy()))
        return arrow_map(docs.select("doc_id", "text"), lambda it: _drop_lines(it, shared, min_length, with_text), schema)
    drops = (keys.join(frequent, ["hi", "lo"]).where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
             .groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))
             .withColumnRenamed("doc_id", "d"))
    joined = docs.select("doc_id", "text").join(drops, F.col("doc_id").eqNullSafe(F.col("d")), "left").select("doc_id", "text", "drops")
    return arrow_map(joined, lambda it: _drop_lines(it, None, min_length, with_text), schema)
