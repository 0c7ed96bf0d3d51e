"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised items go into one automaton whose states are the word sequences
that occur in them.  Each document's words are streamed through it; the length
of the longest match that ends at a word tells whether a window ends there, and
the state tells of which items.  Words, and pairs of neighbouring words, that
no item has are ruled out first in bulk (they are the automaton's transitions
from its first two levels), so that only stretches which may hold a match take
the word-by-word walk.

Items are taken in blocks of bounded size, one automaton and one pass over the
documents each: what is broadcast stays bounded however many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map, fresh, join_rows, row_key, written
from isobar.llm.words import ALNUM, Hasher, find, pieces

WINDOW = 10
#: Item words per automaton, about 0.5 KB each.
BLOCK_WORDS = 200_000
#: Share of a document's words up to which hits are no reason to drop it as a whole.
MAX_SHARE = 0.5
SEED = 41

SPANS = "array<struct<start:int,end:int>>"
RESULT = f"doc_id long, row_key long, n_words long, spans {SPANS}, items array<string>"


class Automaton:
    """States: ``step`` (word -> state), suffix ``link``, longest ``length``."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.hasher = window, Hasher(SEED, lower=True)
        self.step, self.link, self.length = [{}], [-1], [0]
        names = [n for n, _ in items]
        hashes = []
        for p in pieces(pa.array([t.decode() for _, t in items], pa.large_string()), ALNUM):
            h = self.hasher.ranges(p.data, p.start, p.end)
            hashes += [h[p.word0[i]:p.word0[i + 1]] for i in range(p.n_texts)]
        self.vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        texts = [np.searchsorted(self.vocabulary, h).tolist() for h in hashes]
        self.short: dict[tuple[int, int], set[str]] = {}  # (state, length): whole items
        found: dict[int, set[str]] = {}
        size = max(len(self.vocabulary), 1)
        self.pairs = np.unique(np.array([a * size + b for t in texts for a, b in zip(t, t[1:])], np.int64))
        ends = []
        for t in texts:
            last, states = 0, []
            for c in t:
                last = self._extend(last, c)
                states.append(last)
            ends.append(states)
        for name, states in zip(names, ends):
            if 0 < len(states) < window:
                s = self.at_length(states[-1], len(states))
                self.short.setdefault((s, len(states)), set()).add(name)
            for s in states[window - 1:]:
                found.setdefault(self.at_length(s, window), set()).add(name)
        self.items = found
        #: shortest window of two words or more; words that are windows by themselves
        self.least = min((min(len(s), window) for s in ends if len(s) > 1), default=1 << 30)
        self.single = np.unique(np.array([t[0] for t in texts if len(t) == 1 or t and window == 1], np.int64))
        self.short_lengths = sorted({k for _, k in self.short})

    def _new(self, length: int) -> int:
        self.step.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, c: int) -> int:
        """The state for p's longest sequence followed by c; parted from a longer one if need be."""
        q = self.step[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        new = self._new(self.length[p] + 1)
        self.step[new], self.link[new], self.link[q] = dict(self.step[q]), self.link[q], new
        while p != -1 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        if c in self.step[last]:
            return self._split(last, c)
        cur, p = self._new(self.length[last] + 1), last
        while p != -1 and c not in self.step[p]:
            self.step[p][c] = cur
            p = self.link[p]
        self.link[cur] = 0 if p == -1 else self._split(p, c)
        return cur

    def at_length(self, s: int, length: int) -> int:
        """The state of the suffix with so many words of s's sequence."""
        while self.length[self.link[s]] >= length:
            s = self.link[s]
        return s

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of each window occurrence, by its end."""
        s = run = 0
        for i, c in enumerate(words):
            while s and c not in self.step[s]:
                s = self.link[s]
                run = self.length[s]
            if c in self.step[s]:
                s, run = self.step[s][c], run + 1
            if run >= self.window:
                yield i + 1 - self.window, i + 1, self.items.get(self.at_length(s, self.window), set())
            for k in self.short_lengths:
                if k > run:
                    break
                names = self.short.get((self.at_length(s, k), k))
                if names:
                    yield i + 1 - k, i + 1, names

    def stretches(self, ids: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[first, end) of maximal runs whose words and neighbour pairs all occur in items."""
        n = len(ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        good = np.zeros(n + 1, bool)  # good[i]: words i-1 and i may follow one another
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0) & (text_of[:-1] == text_of[1:]))
        good[at[find(self.pairs, ids[at] * len(self.vocabulary) + ids[at + 1]) >= 0] + 1] = True
        first = np.flatnonzero((ids >= 0) & ~good[:n])
        end = np.flatnonzero((ids >= 0) & ~good[1:]) + 1
        long = end - first >= self.least
        if len(self.single):
            count = np.concatenate([[0], np.cumsum(find(self.single, ids) >= 0)])
            long |= count[end] > count[first]
        return first[long], end[long]


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _united(spans: Column) -> Column:
    """The spans sorted, with those that touch or overlap made one."""
    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (s["start"] <= last["end"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def _scan(auto):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Automaton = auto.value
        for batch in batches:
            n = batch.num_rows
            words, spans, items = np.zeros(n, np.int64), [[]] * n, [[]] * n
            for p in pieces(batch.column("text"), ALNUM):
                words[p.first:p.first + p.n_texts] = p.n_words
                ids = find(a.vocabulary, a.hasher.ranges(p.data, p.start, p.end))
                hits: dict[int, tuple[list, set]] = {}
                for first, end in zip(*(x.tolist() for x in a.stretches(ids, p.text_of))):
                    text = int(p.text_of[first])
                    shift = first - int(p.word0[text])
                    for i, j, names in a.stream(ids[first:end].tolist()):
                        at = hits.setdefault(text, ([], set()))
                        at[0].append((i + shift, j + shift))
                        at[1].update(names)
                for text, (where, names) in hits.items():
                    spans[p.first + text], items[p.first + text] = merged(where), sorted(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(words),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "row_key", "n_words", "spans", "items"])
    return scan


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of docs: doc_id, row_key, n_words, spans (hit word ranges) and items.

    Null or empty texts have no words, items without words match nothing, an
    item without id counts under the empty id, and items that share an id are
    one.  Words and windows never cross texts.  Repeated rows get equal
    results; empty tables on either side are fine.  Rows beyond the columns
    used are ignored.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", row_key(F.col("text")).alias("row_key"), "text")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (block_words * 8)))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    results = []
    for b in range(blocks):  # a block's items are bounded, see BLOCK_WORDS
        rows = items.where(F.col("block") == b).distinct().collect()
        auto = spark.sparkContext.broadcast(
            Automaton(sorted((r["item"], r["text"].encode()) for r in rows), window))
        results.append(arrow_map(slim, _scan(auto), RESULT))
    if blocks == 1:
        return results[0]
    hits = [written(r.where(F.size("spans") > 0), "decontam-hits") for r in results]
    some = hits[0]
    for h in hits[1:]:
        some = some.unionByName(h)
    every = (some.dropDuplicates(["doc_id", "row_key", "spans", "items"]).groupBy("doc_id", "row_key")
             .agg(F.flatten(F.collect_list("spans")).alias("spans"),
                  F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    # at most one short list per block and document
    every = every.select(F.col("doc_id").alias("d"), F.col("row_key").alias("k"), "spans", "items").withColumn(
        "spans", _united(F.col("spans")))
    base = results[0].select("doc_id", "row_key", "n_words")
    return (base.join(every, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k")), "left")
            .select("doc_id", "row_key", "n_words",
                    F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def report(found: DataFrame) -> DataFrame:
    """The matches as one digest row per document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def by_length(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(items of a full window or more, items of fewer words); items without words are in neither."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = F.size(F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)))
    return benchmark.where(n >= window), benchmark.where((n > 0) & (n < window))


def contaminated(docs: DataFrame, found: DataFrame, short: DataFrame | None = None,
                 max_share: float = MAX_SHARE) -> tuple[DataFrame, DataFrame]:
    """(rows of docs without any match, the matching rows' doc_id and row_key).

    ``short`` has the matches of items that are shorter than a window: they
    count where they cover more than ``max_share`` of the words.
    """
    bad = found.where(F.size("spans") > 0).select("doc_id", "row_key")
    if short is not None:
        n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
        bad = bad.unionByName(short.where(n_hit > max_share * F.col("n_words")).select("doc_id", "row_key"))
    bad = written(bad.distinct(), "contaminated")
    return join_rows(docs, bad, "left_anti"), bad


def _cuts(found: DataFrame, max_span: int, max_share: float, short: DataFrame | None = None) -> DataFrame:
    """Of each row with hits: doc_id, row_key, the spans to cut and whether it leaves altogether."""
    def hits(m: DataFrame, spans) -> DataFrame:
        n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
        return m.where(F.size("spans") > 0).select("doc_id", "row_key", spans.alias("spans"), (n_hit > max_share * F.col("n_words")).alias("leaves"))
    every = hits(found, F.filter("spans", lambda s: s["end"] - s["start"] > max_span))
    if short is not None:
        every = every.unionByName(hits(short, F.array().cast(SPANS)).where("leaves"))
    # repeated rows have equal spans; those of short items are empty
    return every.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.max("leaves").alias("leaves"))


def remove_spans(docs: DataFrame, found: DataFrame, max_span: int = 0, max_share: float = 1.0) -> DataFrame:
    """docs without the matched spans of more than ``max_span`` words.

    Documents of whose words more than ``max_share`` are hit leave altogether.
    Columns stay; n_chars, if there, follows the text.
    """
    cut = written(_cuts(found, max_span, max_share), "decontam-cuts")
    stay = join_rows(docs, cut.where("leaves").select("doc_id", "row_key"), "left_anti")
    return _excised(stay, cut, "left")


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_span: int = 0,
            max_share: float = MAX_SHARE) -> DataFrame:
    """docs with the benchmark's passages cut out of their texts.

    Spans covered by windows of items go if they have more than ``max_span``
    words; documents of whose words more than ``max_share`` are covered leave
    as a whole.  Items shorter than a window are common phrases too often to
    be cut: they count by coverage alone.  Cutting may bring words together
    that make a window anew: such documents, looked through once more, leave
    as well.

    Columns stay, whatever their names; n_chars, if there, follows the text.
    Null and empty texts stay, as does everything without items.  Repeated
    rows fare alike.  Texts of any length are streamed whole.
    """
    full, short = by_length(benchmark, window)
    found = matches(docs, full, window)
    some = None if short.isEmpty() else matches(docs, short, window)
    cut = written(_cuts(found, max_span, max_share, some), "decontam-cuts")
    rest = join_rows(docs, cut.select("doc_id", "row_key"), "left_anti")
    edited = written(_excised(docs, cut.where(~F.col("leaves")), "inner"), "decontam-edited")
    again = _cuts(matches(edited, full, window), max_span, max_share, None if some is None else matches(edited, short, window))
    again = written(again.where(F.col("leaves") | (F.size("spans") > 0)).select("doc_id", "row_key"), "decontam-again")
    return rest.unionByName(join_rows(edited, again, "left_anti"))


def _excised(docs: DataFrame, cut: DataFrame, how: str) -> DataFrame:
    """docs joined (left or inner) with the written ``cut``, without its spans."""
    spans_in = fresh(docs, "spans")
    cut = cut.select("doc_id", "row_key", F.col("spans").alias(spans_in))
    joined = join_rows(docs, cut, how, F.size(spans_in) * 8 + 32)

    def excise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, out = batch.column(spans_in).to_pylist(), batch.column("text").to_pylist()
            for p in pieces(batch.column("text"), ALNUM):
                for i in range(p.n_texts):
                    if spans[p.first + i]:
                        at, kept, raw = int(p.offsets[i]), [], p.data.tobytes()
                        for s in spans[p.first + i]:
                            kept.append(raw[at:p.start[p.word0[i] + s["start"]]])
                            at = int(p.end[p.word0[i] + s["end"] - 1])
                        out[p.first + i] = b"".join([*kept, raw[at:p.offsets[i + 1]]]).decode()
            names = [c for c in batch.schema.names if c != spans_in]
            cols = [pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    clean = arrow_map(joined, excise, docs.schema)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean
