"""Word splitting and hashing over whole Arrow batches, with numpy.

A batch's texts lie end to end in one byte buffer.  Words, their hashes and the
hashes of word windows come from a few passes over that buffer, so no Python
object is made for a word.  Texts are taken in pieces of about ``PIECE`` bytes
(one text at least), which bounds memory by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
U64 = np.uint64


def _flags(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: `[^\x20\x09-\x0D]+`, as bytes
SPACED = _flags(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z, as bytes
ALNUM = _flags(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            a, b = np.full(size, self.base, U64), np.full(size, self.inverse, U64)
            a[0] = b[0] = 1
            self.up, self.down = np.cumprod(a), np.cumprod(b)
        return self.up, self.down


class Hasher:
    """64-bit hashes of byte ranges and of windows over hashes."""

    def __init__(self, seed: int, lower: bool):
        r = np.random.default_rng(seed)
        self.byte = r.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        if lower:
            self.byte = self.byte[LOWER]
        self.chars, self.words = (Powers(int(r.integers(1 << 40, 1 << 62))) for _ in range(2))

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        up, down = self.chars.get(len(data) + 1)
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(self.byte[data] * up[: len(data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start])

    def windows(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hash of h[i:i+k] for each i; the caller knows which stay in one text."""
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, U64)
        up, down = self.words.get(len(h) + 1)
        total = np.zeros(len(h) + 1, U64)
        np.cumsum(h * up[: len(h)], out=total[1:])
        return mix((total[k:] - total[:n]) * down[:n])


class Piece:
    """Some consecutive texts of a batch: bytes, words and word counts."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.n_texts = len(offsets) - 1
        w = is_word[data]
        before, after = np.zeros(len(w), bool), np.zeros(len(w), bool)
        before[1:], after[:-1] = w[:-1], w[1:]
        cut = offsets[(offsets > 0) & (offsets < len(w))]
        before[cut], after[cut - 1] = False, False
        self.is_word = w
        self.start = np.flatnonzero(w & ~before)
        self.end = np.flatnonzero(w & ~after) + 1
        #: first word of each text, and one past the last of all
        self.word0 = np.searchsorted(self.start, offsets)
        self.n_words = np.diff(self.word0)
        self.text_of = np.repeat(np.arange(self.n_texts), self.n_words)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def whole(self, k: int) -> np.ndarray:
        """For each window start i: does the k-word window stay in one text?"""
        n = len(self.start) - k + 1
        return self.text_of[:n] == self.text_of[k - 1:] if n > 0 else np.zeros(0, bool)


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column: pa.Array, is_word: np.ndarray, limit: int = PIECE) -> Iterator[Piece]:
    data, offsets = strings(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield Piece(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], is_word)
        i = j


def find(sorted_keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of each h in ``sorted_keys``, or -1."""
    if not len(sorted_keys):
        return np.full(len(h), -1, np.int64)
    at = np.searchsorted(sorted_keys, h)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == h, at, -1)
