"""Substring dedup by recompression: shared high-level symbols reveal long repeats.

1. Every text is recompressed (see recompress); each 50-word window names its
   anchor, a high-level symbol inside it.  Equal windows have equal anchors.
2. Spark groups the anchor keys over all documents; keys in one document only
   cannot lie in a repeat.
3. Windows with a shared anchor are verified by 128-bit hashes of their words,
   grouped to find the smallest document of each.
4. Words covered by a window that a smaller document has are removed.

Texts equal as a whole are settled first, by a fingerprint of all their words,
so that large groups of copies send one text into steps 2 and 3.  Grouping is
by partial sums and joins, never by collecting a key's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map, join_rows, row_key, written
from isobar.llm.recompress import anchors
from isobar.llm.words import SPACED, Hasher, Piece, mix, pieces

WINDOW = 50
ROUNDS = 4
SEEDS = (2027, 2029)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _hashers() -> tuple[Hasher, Hasher]:
    return Hasher(SEEDS[0], lower=False), Hasher(SEEDS[1], lower=False)


def joined_words(p: Piece, keep: np.ndarray | None = None) -> list[bytes]:
    """Each text's (kept) words joined by one space."""
    keep = np.ones(len(p.start), bool) if keep is None else keep
    start, end, text = p.start[keep], p.end[keep], p.text_of[keep]
    if not len(start):
        return [b""] * p.n_texts
    data, mask = p.data.copy(), np.zeros(len(p.data) + 1, np.int8)
    np.add.at(mask, start, 1)
    np.subtract.at(mask, end, 1)
    mask = np.cumsum(mask[:-1]).astype(bool)
    gap = end[:-1][text[1:] == text[:-1]]  # the byte after a word that another one follows
    data[gap], mask[gap] = 0x20, True
    total = np.concatenate([[0], np.cumsum(mask)])[p.offsets]
    out = data[mask].tobytes()
    return [out[a:b] for a, b in zip(total[:-1].tolist(), total[1:].tolist())]


def _fingerprints(p: Piece, h: np.ndarray, hasher: Hasher) -> np.ndarray:
    up, down = hasher.words.get(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=total[1:])
    a, b = p.word0[:-1], p.word0[1:]
    return mix((total[b] - total[a]) * down[a] + p.n_words.astype(np.uint64)).view(np.int64)


def _symbols(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _hashers()
        for batch in batches:
            n = batch.num_rows
            f1, f2, n_words = (np.zeros(n, np.int64) for _ in range(3))
            sha, keys = [], []
            for p in pieces(batch.column("text"), SPACED):
                here = slice(p.first, p.first + p.n_texts)
                h, g = one.ranges(p.data, p.start, p.end), two.ranges(p.data, p.start, p.end)
                f1[here], f2[here], n_words[here] = _fingerprints(p, h, one), _fingerprints(p, g, two), p.n_words
                sha += [hashlib.sha256(t).hexdigest() for t in joined_words(p)]
                start, key = anchors(p, h, window, rounds, one)
                text = p.text_of[start]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                key, cut = key[new].view(np.int64), np.searchsorted(text[new], np.arange(p.n_texts + 1))
                keys += [np.unique(key[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(f1), pa.array(f2), pa.array(n_words),
                 pa.array(sha, pa.string()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "f1", "f2", "n_words", "sha", "keys"])
    return run


def _windows(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _hashers()
        for batch in batches:
            wanted = batch.column("wanted")
            bounds = np.asarray(wanted.offsets)
            values = np.asarray(wanted.values)
            for p in pieces(batch.column("text"), SPACED):
                h, g = one.ranges(p.data, p.start, p.end), two.ranges(p.data, p.start, p.end)
                start, key = anchors(p, h, window, rounds, one)
                text = p.text_of[start]
                cut = np.searchsorted(text, np.arange(p.n_texts + 1))
                take = np.zeros(len(start), bool)
                for i in range(p.n_texts):
                    a, b = cut[i], cut[i + 1]
                    take[a:b] = np.isin(key[a:b].view(np.int64), values[bounds[p.first + i]:bounds[p.first + i + 1]])
                if not take.any():
                    continue
                start, text = start[take], text[take]
                rows = pa.array(text + p.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.windows(h, window)[start].view(np.int64)), pa.array(two.windows(g, window)[start].view(np.int64)),
                     batch.column("doc_id").take(rows), batch.column("row_key").take(rows),
                     pa.array((start - p.word0[text]).astype(np.int32))], ["h1", "h2", "doc_id", "row_key", "pos"])
    return run


def _cut(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at")
            bounds, values = np.asarray(at.offsets), np.asarray(at.values).astype(np.int64)
            n_removed, kept = np.zeros(batch.num_rows, np.int64), []
            for p in pieces(batch.column("text"), SPACED):
                edge = np.zeros(len(p.start) + 1, np.int64)
                for i in range(p.n_texts):
                    starts = np.unique(values[bounds[p.first + i]:bounds[p.first + i + 1]]) + p.word0[i]
                    edge[starts] += 1
                    edge[starts + window] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                n_removed[p.first:p.first + p.n_texts] = np.bincount(p.text_of[gone], minlength=p.n_texts)
                kept += joined_words(p, ~gone)
            out = [batch.column("doc_id"), batch.column("row_key"), pa.array(n_removed),
                   pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string())]
            names = ["doc_id", "row_key", "n_removed", "kept_sha256"]
            if with_text:
                out.append(pa.array([t.decode() for t in kept], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(out, names)
    return run


def _smaller(first: str, doc: str) -> Column:
    """Is there an id below this row's?  A null id comes after all others."""
    return F.col(first).isNotNull() & (F.col(doc).isNull() | (F.col(first) < F.col(doc)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (and kept_text) of every row.

    Words covered by a window of ``window`` words that also starts in a document
    with a smaller id are removed; windows are those of the input.  Null and
    empty texts have no words.  Rows sharing an id are one document, so they
    remove nothing from each other; a null id comes after all others and null
    ids remove nothing from each other.  Empty tables give an empty result.
    """
    slim = docs.select("doc_id", row_key(F.col("text")).alias("row_key"), "text")
    rows = written(arrow_map(slim, _symbols(window, rounds),
                             "doc_id long, row_key long, f1 long, f2 long, n_words long, sha string, keys array<long>"), "symbols")
    # sums are written before they are joined, so that Spark can split a hot key's rows in the join
    first = written(rows.groupBy("f1", "f2").agg(F.min("doc_id").alias("first")), "symbols-texts")
    tagged = rows.join(first, ["f1", "f2"]).withColumn("copy", _smaller("first", "doc_id"))
    tagged = written(tagged.select("doc_id", "row_key", "n_words", "sha", "copy",
                                   F.when(~F.col("copy"), F.col("keys")).alias("keys")), "symbols-first")

    keyed = tagged.where(~F.col("copy")).select("doc_id", "row_key", F.explode("keys").alias("key"))
    shared = written(keyed.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                              F.max(F.col("doc_id").isNull()).alias("no_id"))
                     .where((F.col("lo") < F.col("hi")) | (F.col("lo").isNotNull() & F.col("no_id"))).select("key"), "symbols-keys")
    wanted = written(keyed.join(shared, "key").groupBy("doc_id", "row_key")
                     .agg(F.collect_set("key").alias("wanted")), "symbols-shared")

    found = written(arrow_map(join_rows(slim, wanted, "inner", F.size("wanted") * 8 + 32), _windows(window, rounds),
                              "h1 long, h2 long, doc_id long, row_key long, pos int"), "windows")
    smallest = written(found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                                     F.max(F.col("doc_id").isNull()).alias("no_id"))
                       .where((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & F.col("no_id"))), "windows-first")
    gone = written(found.join(smallest, ["h1", "h2"]).where(_smaller("first", "doc_id"))
                   .groupBy("doc_id", "row_key").agg(F.collect_list("pos").alias("at")), "repeats")

    extra = ", kept_text string" * with_text
    cut = written(arrow_map(join_rows(slim, gone, "inner", F.size("at") * 4 + 32), _cut(window, with_text),
                            "doc_id long, row_key long, n_removed long, kept_sha256 string" + extra), "repeats-cut")
    cut = cut.dropDuplicates(["doc_id", "row_key"]).withColumnsRenamed({"doc_id": "d", "row_key": "k"})
    whole = F.col("copy") & (F.col("n_words") >= window)
    out = tagged.join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k")), "left")
    if with_text:
        out = out.drop("keys").join(slim.dropDuplicates(["doc_id", "row_key"]).withColumnsRenamed({"doc_id": "td", "row_key": "tk"}),
                                    F.col("doc_id").eqNullSafe(F.col("td")) & (F.col("row_key") == F.col("tk")))
        joined = F.array_join(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), " ")
        text = [F.when(whole, F.lit("")).otherwise(F.coalesce("kept_text", joined, F.lit(""))).alias("kept_text")]
    else:
        text = []
    return out.select("doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"), *text)
