"""License scans with a positional index of rare template words.

The index holds, per template, the position of its anchor, the word of highest
IDF in the mandatory key phrase, and the positions of its rarest other words
(document frequencies come from the whole corpus).  Each file's occurrences of
these words are its postings.  An anchor's posting, moved by its position, is a
place where the template may lie: the key phrase is verified there, then the
postings of the rare words are intersected with the stretch that the rest of
the template takes at that place, with slack for inserted words.  As many rare
words are looked up as make sure that a notice which agrees has enough of them
there, so none is lost; what is left is aligned word by word.  The base phrases
are templates that are all key phrase.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import arrow_map
from isobar.llm.words import ALNUM, Hasher, Piece, find, pieces

SEED = 5
#: The share of a template's words that must stand in order, key phrase included.
AGREEMENT = 0.75
#: Rare words beside the key phrase that a place must have, if the template has as many.
VOTES = 3
#: Serialised size of a table of templates, at most: the index is broadcast.
TEMPLATE_BYTES = 8 << 20

# The base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Label, notice text and mandatory key phrase of further templates.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
     "permission is hereby granted free of charge"),
    ("mit", "Released under the MIT License", "the mit license"),
    ("apache-2", "Licensed under the Apache License, Version 2.0", "the apache license version 2"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the "
              "GNU General Public License version 2", "gnu general public license version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     "gnu general public license version 3"),
    ("lgpl-3", "This library is licensed under the GNU Lesser General Public License, version 3",
     "gnu lesser general public license version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "mozilla public license v 2"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc0", "Released under CC0 1.0 Universal Public Domain Dedication", "cc0 1 0 universal"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted", "permission to use copy modify and or distribute this software"),
)


def words_of(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


@dataclass
class Template:
    label: str
    words: np.ndarray  # indices into the vocabulary
    phrase: int        # first word of the mandatory phrase, and its length
    phrase_words: int
    base: bool
    anchor: int = 0    # position of the phrase's rarest word
    votes: int = 0     # how many of the rare words a place must have
    rare: tuple[int, ...] = ()  # positions of the rarest words beside the phrase

    @property
    def slack(self) -> int:
        """Words that may be inserted on either side of the key phrase."""
        return max(2, len(self.words) // 3)

    @property
    def needed(self) -> int:
        return math.ceil(AGREEMENT * len(self.words))

    def weigh(self, idf: np.ndarray) -> None:
        """Choose the words to look up.

        Of the n words beside the phrase x must be there, so of any n - x + v
        of them at least v are.
        """
        end = self.phrase + self.phrase_words
        self.anchor = self.phrase + int(np.argmax(idf[self.words[self.phrase:end]]))
        beside = np.array([q for q in range(len(self.words)) if not self.phrase <= q < end], np.int64)
        x = max(0, self.needed - self.phrase_words)
        self.votes = min(x, VOTES)
        n = len(beside) - x + self.votes if x else 0
        self.rare = tuple(beside[np.argsort(-idf[self.words[beside]], kind="stable")[:n]].tolist())


def in_order(words: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``words``."""
    at: dict[int, int] = {}
    for i, w in enumerate(words):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(words)) - 1
    free = full
    for w in text:
        if w in at:
            hit = free & at[w]
            free = (free + hit | free - hit) & full
    return (full & ~free).bit_count()


def checked(templates: DataFrame) -> list[tuple[str, str, str]]:
    """Label, text and key phrase of a table of templates of bounded size.

    Rows without label or whose phrase has no word or does not stand in the
    text can't be looked up: a ValueError names one.  Repeated rows are one.
    """
    t = templates.select("label", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("phrase", F.lit("")).alias("phrase")).distinct()
    size = t.agg(F.sum(F.octet_length("text") + F.octet_length("phrase"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes, more than {TEMPLATE_BYTES}: scan with parts of the table")
    rows = sorted(map(tuple, t.collect()), key=str)
    for label, text, phrase in rows:
        w, key = words_of(text), words_of(phrase)
        if label is None or not key or all(w[i:i + len(key)] != key for i in range(len(w))):
            raise ValueError(f"template {label!r} has no label or its key phrase is not in its text")
    return rows


class Index:
    """Vocabulary, IDF, anchors and templates; its size is that of the templates."""

    def __init__(self, templates=TEMPLATES):
        self.hasher = Hasher(SEED, lower=True)
        texts = [(label, phrase, phrase, True) for label, phrase in BASE]
        texts += [(label, text, phrase, False) for label, text, phrase in templates]
        every = sorted({w for _, text, _, _ in texts for w in words_of(text)})
        p = next(pieces(pa.array([" ".join(every)]), ALNUM))
        hashes = self.hasher.ranges(p.data, p.start, p.end)
        order = np.argsort(hashes)
        self.vocabulary = hashes[order]
        number = {every[at]: i for i, at in enumerate(order.tolist())}
        self.templates = []
        for label, text, phrase, base in texts:
            w, key = words_of(text), words_of(phrase)
            at = next(i for i in range(len(w)) if w[i:i + len(key)] == key)
            self.templates.append(Template(label, np.array([number[x] for x in w]), at, len(key), base))

    def weigh(self, df: np.ndarray, n_docs: int) -> Index:
        """Set the IDF of every word from its document frequency."""
        idf = np.log((n_docs + 1) / (df + 1))
        self.anchors: dict[int, list[Template]] = {}
        posted = set()
        for t in self.templates:
            t.weigh(idf)
            self.anchors.setdefault(int(t.words[t.anchor]), []).append(t)
            posted.update(t.words[list(t.rare)].tolist())
        self.is_anchor, self.is_posted = (np.isin(np.arange(len(idf) + 1), [*w]) for w in (self.anchors, posted | set(self.anchors)))
        return self

    def postings(self, ids: np.ndarray) -> dict[int, np.ndarray]:
        """Positions in the file of each word looked up; -1, for unknown words, is never one."""
        at = np.flatnonzero(self.is_posted[ids])
        at = at[np.argsort(ids[at], kind="stable")]
        words, first = np.unique(ids[at], return_index=True)
        return dict(zip(words.tolist(), np.split(at, first[1:])))

    def agree(self, ids: np.ndarray, start: np.ndarray, t: Template, a: int, b: int) -> np.ndarray:
        """Words of the template's [a, b) that stand at their places, for each template start."""
        n = np.zeros(len(start), np.int64)
        for q in range(a, b):
            at = start + q
            ok = (at >= 0) & (at < len(ids))
            n[ok] += ids[at[ok]] == t.words[q]
        return n

    def best(self, ids: np.ndarray, s: np.ndarray, t: Template, posted: dict[int, np.ndarray]) -> int:
        """Most words of t in order at a place, of the places s with its key phrase; the phrase's where too few."""
        if (self.agree(ids, s, t, 0, len(t.words)) == len(t.words)).any():
            return len(t.words)
        none, end = np.zeros(0, np.int64), t.phrase + t.phrase_words
        votes = np.zeros(len(s), np.int64)
        for q in t.rare:
            lo, hi = (s - t.slack, s + t.phrase) if q < t.phrase else (s + end, s + len(t.words) + t.slack)
            at = posted.get(int(t.words[q]), none)
            votes += np.searchsorted(at, hi) > np.searchsorted(at, lo)
        most, words = t.phrase_words, t.words.tolist()
        for p in s[votes >= t.votes].tolist():
            before = ids[max(0, p - t.slack):p + t.phrase].tolist()
            after = ids[p + end:max(0, p + len(words) + t.slack)].tolist()
            n = in_order(words[:t.phrase], before) + t.phrase_words + in_order(words[end:], after)
            if n >= t.needed:
                most = max(most, n)
        return most

    def scan(self, ids: np.ndarray) -> tuple[np.ndarray, set[str], set[str], float]:
        """(starts of base phrases, base labels, all labels, score) of one file's words."""
        starts, base, labels, score = [np.zeros(0, np.int64)], set(), set(), 0.0
        posted = self.postings(ids)
        for word, at in posted.items():
            for t in self.anchors.get(word, ()):
                s = at - t.anchor
                s = s[self.agree(ids, s, t, t.phrase, t.phrase + t.phrase_words) == t.phrase_words]
                if not len(s):
                    continue
                if t.base:
                    starts.append(s)
                    base.add(t.label)
                    score = 1.0
                    continue
                n = self.best(ids, s, t, posted)
                score = max(score, n / len(t.words))
                if n >= t.needed:
                    labels.add(t.label)
        return np.sort(np.concatenate(starts)), base, labels | base, score


def _word_ids(index: Index, p: Piece) -> np.ndarray:
    return find(index.vocabulary, index.hasher.ranges(p.data, p.start, p.end))


def corpus_index(docs: DataFrame, templates=TEMPLATES) -> Index:
    """The index with the document frequencies of all texts; a sum per template word."""
    index = Index(templates)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(index.vocabulary), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for p in pieces(batch.column("text"), ALNUM):
                ids = _word_ids(index, p)
                known = np.flatnonzero(ids >= 0)
                pair = np.unique(p.text_of[known] * len(total) + ids[known])
                total += np.bincount(pair % len(total), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array([*range(-1, len(total))]), pa.array([rows, *total.tolist()])], ["word", "df"])

    found = dict(arrow_map(docs.select("text"), frequencies, "word long, df long")
                 .groupBy("word").agg(F.sum("df")).collect())  # one row per template word
    df = np.array([found.get(w, 0) for w in range(len(index.vocabulary))])
    return index.weigh(df, found.get(-1, 0))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """Licence labels of every row of docs.

    ``templates`` (label, text, phrase) replaces the built-in notices; its size
    is checked (:func:`checked`).  ``score`` is the largest share of a
    template's words found in order at a place with its key phrase; a place
    short of the agreement counts its key phrase alone, a base phrase counts 1.

    Null and empty texts have no words, no places (first_word and last_word
    null) and empty label strings.  Places may overlap; each counts.  Repeated
    rows get equal results; an empty table gives an empty one.  Texts of any
    length are scanned whole.  Columns other than doc_id and text are ignored,
    whatever their names.
    """
    notices = TEMPLATES if templates is None else checked(templates)
    shared = docs.sparkSession.sparkContext.broadcast(corpus_index(docs, notices))  # size of the templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            n = batch.num_rows
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last = [None] * n, [None] * n
            base, labels, score = [""] * n, [""] * n, np.zeros(n)
            for p in pieces(batch.column("text"), ALNUM):
                n_words[p.first:p.first + p.n_texts] = p.n_words
                ids = _word_ids(index, p)
                for i in np.unique(p.text_of[index.is_anchor[ids]]).tolist():
                    starts, b, every, s = index.scan(ids[p.word0[i]:p.word0[i + 1]])
                    row = p.first + i
                    n_base[row], score[row] = len(starts), s
                    if len(starts):
                        first[row], last[row] = int(starts[0]), int(starts[-1])
                    base[row], labels[row] = ",".join(sorted(b)), ",".join(sorted(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_base), pa.array(first, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(base), pa.array(labels), pa.array(score)],
                [c.split()[0] for c in SCHEMA.split(", ")])

    return arrow_map(docs.select("doc_id", "text"), run, SCHEMA)
