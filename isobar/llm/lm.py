"""Language-model scoring with a hidden Markov model.

Tokens map to a bounded set of symbols: the most frequent training words have
one each, all other words share classes (by the kinds of characters they hold
and a hash), and a word of a class gets its share of the class by its own
count.  The states are trained by Baum-Welch: tasks sum expected counts over
their texts, Spark sums them per symbol, and the next model is made of the
totals.  Texts are scored by the scaled forward recursion, which is exact.

Word counts are exact and cover all training texts.  The frequent words'
counts reach the tasks by broadcast (their number is a parameter); all other
words meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm import hmm
from isobar.llm.classifier import KIND
from isobar.llm.common import arrow_map, written
from isobar.llm.words import LOWER, SPACED, Hasher, Piece, find, mix, pieces

#: Words with a symbol of their own; hash classes per kind of word (64 kinds).
FREQUENT, HASHES = 32_768, 32
STATES, ITERATIONS = 8, 6
#: Texts of more than LONG tokens advance in pieces of SEQUENCE tokens, whose ends are found exactly (plan only).
LONG, SEQUENCE = 1024, 512
STAY, SPREAD, PRIOR, SEED = 0.95, 1.0, 200.0, 606
GROUP_TOKENS = 1 << 19
U64 = np.uint64
N_CLASSES = 64 * HASHES


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 5 (null id: not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def take_words(p: Piece, at: np.ndarray) -> pa.Array:
    """The words at these indices, A-Z lower-cased."""
    start, size = p.start[at], p.end[at] - p.start[at]
    offsets = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    data = LOWER[p.data[where]] if len(where) else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def word_class(p: Piece, h: np.ndarray) -> np.ndarray:
    """Class of each word: which kinds of characters it holds (cases are one), and a hash."""
    if not len(h):
        return np.zeros(0, np.int64)
    kind = np.bitwise_or.reduceat(KIND[LOWER[p.data]], p.start).astype(np.int64)
    kind = (kind & 1) | (kind >> 1 & 62)
    return kind * HASHES + (mix(h + U64(17)) % U64(HASHES)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(SEED, lower=True)
    for batch in batches:
        hashes, counts, words = [], [], []
        for p in pieces(batch.column("text"), SPACED):
            u, at, c = np.unique(hasher.ranges(p.data, p.start, p.end), return_index=True, return_counts=True)
            hashes.append(u)
            counts.append(c)
            words.append(take_words(p, at))
        if not hashes:
            continue
        _, at, group = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        n = np.bincount(group, weights=np.concatenate(counts)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.chunked_array(words, pa.string()).combine_chunks().take(pa.array(at)), pa.array(n)], ["word", "c"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all words of the training rows."""
    train = docs.where(~held_out(F.col("doc_id"))).select("text")
    return written(arrow_map(train, _count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


class Vocabulary:
    """Symbols and what is known of their counts; its size is a parameter."""

    def __init__(self, words: list[str], counts: list[int], classes: np.ndarray, distinct: np.ndarray, n_end: int):
        self.hasher = Hasher(SEED, lower=True)
        h = np.zeros(0, U64)
        if words:
            p = [self.hasher.ranges(x.data, x.start, x.end) for x in pieces(pa.array(words, pa.large_string()), SPACED)]
            h = np.concatenate(p)
        order = np.argsort(h)
        self.hashes, self.counts = h[order], np.array(counts, np.float64)[order]
        self.end = len(h) + N_CLASSES
        self.class_weight = classes + 0.5 * (distinct + 1)
        weight = np.concatenate([self.counts + 0.5, self.class_weight, [n_end + 0.5]])
        self.unigram = weight / weight.sum()

    def symbols(self, p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, index among the frequent words or -1, class) of each word."""
        h = self.hasher.ranges(p.data, p.start, p.end)
        at, cls = find(self.hashes, h), word_class(p, h)
        return np.where(at >= 0, at, len(self.hashes) + cls), at, cls


def _class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(SEED, lower=True)
    total, distinct = np.zeros(N_CLASSES), np.zeros(N_CLASSES)
    for batch in batches:
        c = batch.column("c").to_numpy()
        for p in pieces(batch.column("word"), SPACED):  # a word each
            cls = word_class(p, hasher.ranges(p.data, p.start, p.end))
            total += np.bincount(cls, weights=c[p.first:p.first + p.n_texts], minlength=N_CLASSES)
            distinct += np.bincount(cls, minlength=N_CLASSES)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_CLASSES)), pa.array(total), pa.array(distinct)], ["cls", "total", "distinct"])


def frequent_words(counts: DataFrame, frequent: int = FREQUENT) -> Column:
    """Condition for the ``frequent`` most frequent words; of the words that tie for
    the last places those with the smallest hashes, by 4,096ths of all hashes."""
    least, room = 1 << 62, frequent
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(frequent + 1).collect():
        if r["n"] > room:
            tied = F.pmod(F.xxhash64("word"), F.lit(4096))
            upto = 0
            for t in counts.where(F.col("c") == r["c"]).groupBy(tied.alias("t")).agg(F.count("*").alias("n")).orderBy("t").collect():
                room -= t["n"]
                if room < 0:
                    break
                upto = t["t"] + 1
            return (F.col("c") >= least) | ((F.col("c") == r["c"]) & (tied < upto))
        room -= r["n"]
        least = r["c"]
    return F.col("c") >= least


def vocabulary(counts: DataFrame, n_train: int, frequent: int = FREQUENT) -> tuple[Vocabulary, Column]:
    """The vocabulary, and the condition for a frequent word."""
    own = frequent_words(counts, frequent)
    rows = counts.where(own).collect()  # at most ``frequent`` rows
    rows = sorted((r["word"], r["c"]) for r in rows)
    sums = (arrow_map(counts.where(~own), _class_sums, "cls long, total double, distinct double")
            .groupBy("cls").agg(F.sum("total").alias("t"), F.sum("distinct").alias("d")).toPandas())  # a row per class
    total, distinct = np.zeros(N_CLASSES), np.zeros(N_CLASSES)
    total[sums["cls"]], distinct[sums["cls"]] = sums["t"], sums["d"]
    return Vocabulary([w for w, _ in rows], [c for _, c in rows], total, distinct, n_train), own


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        log_count, log_class = np.log10(v.counts + 0.5), np.log10(v.class_weight)
        for batch in batches:
            n = batch.num_rows
            n_words, n_rare = np.zeros(n, np.int64), np.zeros(n, np.int64)
            log_hot, class_log = np.zeros(n), np.zeros(n)
            codes, rare = [], []
            for p in pieces(batch.column("text"), SPACED):
                here = slice(p.first, p.first + p.n_texts)
                symbol, at, cls = v.symbols(p)
                hot = at >= 0
                n_words[here] = p.n_words
                n_rare[here] = np.bincount(p.text_of[~hot], minlength=p.n_texts)
                log_hot[here] = np.bincount(p.text_of[hot], weights=log_count[at[hot]], minlength=p.n_texts)
                class_log[here] = np.bincount(p.text_of[~hot], weights=log_class[cls[~hot]], minlength=p.n_texts)
                symbol = symbol.astype(np.uint16)
                codes += [symbol[a:b].tobytes() for a, b in zip(p.word0[:-1].tolist(), p.word0[1:].tolist())]
                rare.append(take_words(p, np.flatnonzero(~hot)))
            words = pa.chunked_array(rare, pa.string()).combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), batch.column("held_out"), pa.array(n_words), pa.array(n_rare),
                 pa.array(log_hot), pa.array(class_log), pa.array(codes, pa.binary()), lists],
                ["rid", "doc_id", "held_out", "n_words", "n_rare", "log_hot", "class_log", "codes", "rare"])
    return run


def _texts(batch: pa.RecordBatch, end: int) -> Iterator[np.ndarray]:
    """The symbols of each text, the end symbol last."""
    for code in batch.column("codes"):
        yield np.append(np.frombuffer(code.as_py(), np.uint16).astype(np.int64), end)


def _parts(m: hmm.Model, batch: pa.RecordBatch, end: int) -> Iterator[hmm.Parts]:
    """The texts' sequences in groups of about GROUP_TOKENS tokens."""
    short, held = [], 0
    step = GROUP_TOKENS // SEQUENCE
    waiting, n_waiting = [], 0  # pieces of long texts
    for s in _texts(batch, end):
        if len(s) <= LONG:
            short.append(s)
            held += len(s)
            if held >= GROUP_TOKENS:
                yield hmm.Parts.whole(m, short)
                short, held = [], 0
            continue
        waiting.append(s)
        n_waiting += len(s)
        if n_waiting >= GROUP_TOKENS:
            yield from _long(m, waiting, step)
            waiting, n_waiting = [], 0
    if waiting:
        yield from _long(m, waiting, step)
    if short:
        yield hmm.Parts.whole(m, short)


def _long(m: hmm.Model, texts: list[np.ndarray], step: int) -> Iterator[hmm.Parts]:
    both = hmm.Parts.together([p for p, _ in hmm.cut_up(m, texts, SEQUENCE, step)])
    for a in range(0, len(both.sequences), step):
        yield both.part(a, a + step)


def _expect(shared, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: hmm.Model = shared.value
        k = len(m.start)
        starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((len(m.emit), k))
        for batch in batches:
            for group in _parts(m, batch, end):
                s, a, e = hmm.expected_counts(m, group)
                starts += s
                moves += a
                emits += e
        used = np.flatnonzero(emits.sum(axis=1) > 0)
        # symbols count up from 0; -1 holds the starts, -2 - i the moves from state i
        symbol = np.concatenate([[-1], -2 - np.arange(k), used])
        values = np.vstack([starts[None, :], moves, emits[used]])
        yield pa.RecordBatch.from_arrays([pa.array(symbol), *(pa.array(values[:, j]) for j in range(k))],
                                         ["symbol", *(f"s{j}" for j in range(k))])
    return run


def train(coded: DataFrame, v: Vocabulary, states: int = STATES, iterations: int = ITERATIONS) -> hmm.Model:
    """Baum-Welch over all training texts of the coded table."""
    sc = coded.sparkSession.sparkContext
    model = hmm.Model.seeded(v.unigram, states, STAY, SPREAD, SEED)
    texts = coded.where(~F.col("held_out")).select("codes")
    names = [f"s{j}" for j in range(states)]
    for _ in range(iterations):
        shared = sc.broadcast(model)  # symbols x states, both parameters
        sums = (arrow_map(texts, _expect(shared, v.end), "symbol long, " + ", ".join(f"{x} double" for x in names))
                .groupBy("symbol").agg(*[F.sum(x).alias(x) for x in names]).toPandas())  # a row per symbol
        full = np.zeros((states + 1 + len(v.unigram), states))
        full[sums["symbol"].to_numpy() + states + 1] = sums[names].to_numpy()
        moves = full[:states][::-1]
        model = model.improved(full[states], moves, full[states + 1:], v.unigram, PRIOR)
    return model


def _score(shared, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: hmm.Model = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            groups: dict[bool, list] = {True: [], False: []}  # long texts and others, (row, symbols)
            held = {True: 0, False: 0}

            def settle(far: bool) -> None:
                rows, texts = [i for i, _ in groups[far]], [s for _, s in groups[far]]
                out[rows] = ([x for _, x in hmm.cut_up(m, texts, SEQUENCE, GROUP_TOKENS // SEQUENCE)] if far
                             else hmm.log10_likelihood(m, texts))
                groups[far], held[far] = [], 0

            for i, s in enumerate(_texts(batch, end)):
                far = len(s) > LONG
                groups[far].append((i, s))
                held[far] += len(s)
                if held[far] >= GROUP_TOKENS:
                    settle(far)
            for far in (True, False):
                if groups[far]:
                    settle(far)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "log_symbols"])
    return run


def score(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Null and empty texts have one token, the end.  Rows are scored one by one,
    so repeated ids and rows do no harm; a null id is not held out.  Without
    training rows every count is 0 and the model is the unseeded start.  An
    empty table gives an empty result.  Texts of any length are trained on and
    scored whole; a long one is held by its task at eight bytes a token.
    """
    docs = docs.select("doc_id", "text")
    counts = word_counts(docs)
    n_train = docs.where(~held_out(F.col("doc_id"))).count()
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    n, distinct = (sums[0] or 0) + n_train, sums[1] + (n_train > 0)
    v, own = vocabulary(counts, n_train, frequent)
    sc = docs.sparkSession.sparkContext
    coded = written(arrow_map(
        docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"),
        _encode(sc.broadcast(v)),
        "rid long, doc_id long, held_out boolean, n_words long, n_rare long, log_hot double, class_log double, codes binary, rare array<string>"), "coded")

    # the other words meet their counts
    met = (coded.select("rid", F.explode("rare").alias("word")).join(counts.where(~own), "word", "left")
           .groupBy(F.col("rid").alias("r")).agg(F.count("c").alias("known_rare"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log_rare")))
    model = train(coded, v, states, iterations)
    slim = coded.select("rid", "doc_id", "held_out", "n_words", "n_rare", "log_hot", "class_log", "codes")
    scored = arrow_map(slim, _score(sc.broadcast(model), v.end),
                       "rid long, doc_id long, held_out boolean, n_words long, n_rare long, log_hot double, class_log double, codes binary, log_symbols double").drop("codes")
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    log_all = F.col("log_hot") + log_rare + F.lit(float(np.log10(n_train + 0.5)))
    n_tokens = F.col("n_words") + 1
    known = F.col("n_words") - F.col("n_rare") + F.coalesce("known_rare", F.lit(0)) + F.lit(1 if n_train else 0)
    return scored.join(met, F.col("rid") == F.col("r"), "left").select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), known.cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (log_all - n_tokens * F.lit(float(np.log10(n + 0.5 * (distinct + 1))))).alias("base_score"),
        (F.col("log_symbols") + log_rare - F.col("class_log")).alias("score"))
