"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates.

A text's features are its word unigrams and bigrams and, as n-grams of a
coarser alphabet, the shapes of its words (which kinds of character a word has,
and whether it repeats the word before) up to trigrams.  All are hashed into
one weight vector.  A feature's value is its share of the text's n-grams of
that kind, so scores do not depend on length, and a score is one sparse dot
product: the mean weight over the n-grams of each kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map, bounded, fresh, written
from isobar.llm.words import SPACED, Hasher, Piece, mix, pieces

BITS = 18
#: About so many labelled rows are learned from, drawn by hash of the id.
SAMPLE_ROWS = 16_384
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 0.05, 0.002, 0.02
THRESHOLD = 0.7
SEED = 77
#: Weight of each kind of n-gram: words, word pairs, shapes, shape pairs, shape triples.
SCALES = (3.0, 3.0, 6.0, 6.0, 6.0)
U64 = np.uint64


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        kind[b] = (1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 4 if "0" <= c <= "9"
                   else 8 if c in ".,;:?'\"()-" else 16 if c == "!" else 32 if 0x20 < b < 0x7F
                   else 64 if b >= 0x80 else 0)
    return kind


KIND = _kinds()


def ngrams(p: Piece, hasher: Hasher) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: (text of it, index of its weight); index 0 is the bias."""
    h = hasher.ranges(p.data, p.start, p.end)
    if not len(h):
        return []
    shape = np.bitwise_or.reduceat(KIND[p.data], p.start).astype(U64)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (p.text_of[1:] == p.text_of[:-1])
    shape |= same.astype(U64) << U64(7)
    shape = mix(shape + U64(1))
    out = []
    for base, sizes in ((h, (1, 2)), (shape, (1, 2, 3))):
        for k in sizes:
            whole = p.whole(k)
            g = base if k == 1 else hasher.windows(base, k)
            index = mix(g + U64(k + (100 if base is shape else 0))) >> U64(64 - BITS)
            out.append((p.text_of[:len(g)][whole], np.maximum(index[whole], U64(1)).astype(np.int64)))
    return out


def scores(p: Piece, hasher: Hasher, w: np.ndarray) -> np.ndarray:
    z = np.full(p.n_texts, w[0], np.float64)
    for (text, index), scale in zip(ngrams(p, hasher), SCALES):
        n = np.bincount(text, minlength=p.n_texts)
        z += scale * np.bincount(text, weights=w[index], minlength=p.n_texts) / np.maximum(n, 1)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _vectors(p: Piece, hasher: Hasher) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vector of each text of the piece: sorted indices and values."""
    grams = ngrams(p, hasher)
    out = []
    for i in range(p.n_texts):
        index, value = [np.zeros(1, np.int64)], [np.ones(1)]
        for (text, at), scale in zip(grams, SCALES):
            a, b = np.searchsorted(text, [i, i + 1])
            if b > a:
                u, c = np.unique(at[a:b], return_counts=True)
                index.append(u)
                value.append(scale * c / (b - a))
        u, where = np.unique(np.concatenate(index), return_inverse=True)
        out.append((u.astype(np.int32), np.bincount(where, weights=np.concatenate(value)).astype(np.float32)))
    return out


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over the rows in their order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, x, y in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[at] = grown
    return weights(z, n)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, rows = Hasher(SEED, lower=False), []
    for batch in batches:
        label = batch.column("label").to_pylist()
        for p in pieces(batch.column("text"), SPACED):
            rows += [(*v, label[p.first + i]) for i, v in enumerate(_vectors(p, hasher))]
    w = ftrl(rows) if rows else np.zeros(1 << BITS)
    yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary())], ["weights"])


def held_out(doc_id: Column) -> Column:
    """The rows kept from training: crc32 of the id as text leaves 2 modulo 4 (null id: not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights (2**BITS floats) learned from about ``sample_rows`` labelled rows that are not held out.

    The draw takes the ids whose hash is below sample_rows / labelled rows, so
    it is the same on every run and needs no sort.  The sample, being bounded,
    is learned from in one task, in order of the hash.  Null labels and null
    ids are not used; an id labelled twice counts once, with its larger label.
    """
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").cast("int").alias("label")))
    usable = written(usable.withColumn("draw", F.xxhash64(F.lit(SEED), "label_id")), "labels")
    n = usable.count()
    if n > sample_rows:
        usable = usable.where(F.col("draw") < F.lit(int((sample_rows / n * 2 - 1) * (1 << 63))))
    rows = (docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
            .join(bounded(usable, F.lit(24)), F.col("doc_id") == F.col("label_id"))
            .select("draw", "label", "text", "doc_id"))
    rows = rows.repartition(1).sortWithinPartitions("draw", "doc_id", "text").select("label", "text")
    model = arrow_map(rows, _train, "weights binary").first()
    return np.frombuffer(model["weights"], np.float32) if model else np.zeros(1 << BITS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """docs with one more column, the probability of label 1.

    Null and empty texts get the score of the bias alone.  Without any labels
    every score is 0.5.  Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS floats, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(SEED, lower=False), shared.value
        for batch in batches:
            s = np.zeros(batch.num_rows)
            for p in pieces(batch.column("text"), SPACED):
                s[p.first:p.first + p.n_texts] = scores(p, hasher, w)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, name])

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted good, with docs' columns.

    All rows stay if there are no usable labels: no model rejects them.
    """
    name, weights = fresh(docs, "score"), fit(docs, labels)
    if not weights.any():  # nothing was learned
        return docs
    return score(docs, weights, name).where(F.col(name) >= THRESHOLD).drop(name)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
