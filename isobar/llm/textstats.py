"""Statistics of whole texts, per batch, for the quality rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isobar.llm.common import arrow_map
from isobar.llm.words import SPACED, Hasher, Piece, pieces

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_bangs", "n_stutter")
REPEAT_WINDOW = 8
_SYMBOL, _UPPER, _BANG = (np.isin(np.arange(256), list(s)) for s in
                          (b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!"))


def again(text_of: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """Positions whose (text, hash) occurs twice or more."""
    bits = max(1, int(n_texts).bit_length())
    key = (text_of.astype(np.uint64) << np.uint64(64 - bits)) | (h >> np.uint64(bits))
    s = np.sort(key)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.searchsorted(twice, key)
    at[at == len(twice)] = 0
    found = np.flatnonzero(twice[at] == key)
    # the key has lost some bits of the hash; settle it with all of them
    order = found[np.lexsort((h[found], text_of[found]))]
    same = (text_of[order][1:] == text_of[order][:-1]) & (h[order][1:] == h[order][:-1])
    keep = np.zeros(len(order), bool)
    keep[1:] |= same
    keep[:-1] |= same
    return np.sort(order[keep])


def piece_stats(p: Piece, hasher: Hasher) -> np.ndarray:
    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[p.offsets[1:]] - total[p.offsets[:-1]]

    out = np.zeros((len(NAMES), p.n_texts), np.int64)
    d = p.data
    out[0] = p.n_words
    out[1] = per_text(p.is_word & ((d & 0xC0) != 0x80))
    out[2], out[6], out[7] = per_text(_SYMBOL[d]), per_text(_UPPER[d]), per_text(_BANG[d])
    # lines: each text's bytes split at \n
    newline = np.flatnonzero(d == 10)
    start = np.sort(np.concatenate([p.offsets[:-1], newline + 1]))
    text = np.sort(np.concatenate([np.arange(p.n_texts), np.searchsorted(p.offsets, newline, side="right") - 1]))
    first = np.concatenate([[True], text[1:] != text[:-1]])[:len(text)]
    end = np.concatenate([np.where(first[1:], p.offsets[1:][text[:-1]], start[1:] - 1), p.offsets[-1:]])[:len(text)]
    out[5] = np.bincount(text, minlength=p.n_texts)
    wordy = np.searchsorted(p.start, end) > np.searchsorted(p.start, start)
    if wordy.any():
        t, h = text[wordy], hasher.ranges(d, start[wordy], end[wordy])
        order = np.lexsort((h, t))
        dup = (t[order][1:] == t[order][:-1]) & (h[order][1:] == h[order][:-1])
        out[3] = np.bincount(t[order][1:][dup], minlength=p.n_texts)
    h = hasher.ranges(d, p.start, p.end)
    if len(h) > 1:
        stutter = (h[1:] == h[:-1]) & (p.text_of[1:] == p.text_of[:-1])
        out[8] = np.bincount(p.text_of[1:][stutter], minlength=p.n_texts)
    whole = np.flatnonzero(p.whole(REPEAT_WINDOW))
    if len(whole):
        at = whole[again(p.text_of[whole], hasher.windows(h, REPEAT_WINDOW)[whole], p.n_texts)]
        edge = np.zeros(len(h) + 1, np.int64)
        edge[at] += 1
        np.subtract.at(edge, at + REPEAT_WINDOW, 1)
        out[4] = np.bincount(p.text_of[np.cumsum(edge[:-1]) > 0], minlength=p.n_texts)
    return out


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(101, lower=False)
    for batch in batches:
        out = np.zeros((len(NAMES), batch.num_rows), np.int64)
        for p in pieces(batch.column("text"), SPACED):
            out[:, p.first:p.first + p.n_texts] = piece_stats(p, hasher)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)], ["doc_id", *NAMES])


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the counts NAMES of every row; null texts count as empty."""
    return arrow_map(docs.select("doc_id", "text"), _stats, "doc_id long, " + ", ".join(f"{n} long" for n in NAMES))
