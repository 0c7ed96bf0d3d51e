"""Locally consistent symbols by recompression.

A round names, from content alone, the runs of equal symbols and then the pairs
(left, right) of neighbours, where a coin tossed per symbol name says which
side it may take.  A name is a hash of what it stands for, so all tasks give
the same name to the same content without asking each other.

Each symbol carries its context: the word range that decides that the symbol
stands there.  Equal words over a symbol's whole context give the equal symbol,
wherever the texts around differ.  So a repeated passage shares every interior
symbol whose context lies inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from isobar.llm.words import Hasher, Piece, mix

U64 = np.uint64
RUN, PAIR = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


@dataclass
class Level:
    """Symbols in order: name, text, and context [lo, hi) in the piece's words.

    A context that reaches beyond its text gets lo or hi outside the text.
    """

    name: np.ndarray
    text: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def words_level(p: Piece, h: np.ndarray) -> Level:
    at = np.arange(len(h), dtype=np.int64)
    return Level(h, p.text_of, at, at + 1)


def _neighbours(x: Level, p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo of the left neighbour, hi of the right one, has left, has right)."""
    left, right = np.zeros(len(x.name), bool), np.zeros(len(x.name), bool)
    left[1:] = x.text[1:] == x.text[:-1]
    right[:-1] = left[1:]
    lo, hi = p.word0[x.text] - 1, p.word0[x.text + 1] + 1
    lo[left], hi[right] = x.lo[:-1][left[1:]], x.hi[1:][right[:-1]]
    return lo, hi, left, right


def compress_runs(x: Level, p: Piece) -> Level:
    lo, hi, left, _ = _neighbours(x, p)
    same = np.zeros(len(x.name), bool)
    same[1:] = left[1:] & (x.name[1:] == x.name[:-1])
    first = np.flatnonzero(~same)
    count = np.diff(np.append(first, len(same)))
    last = first + count - 1
    name = x.name[first]
    run = count > 1
    name[run] = mix((name[run] * RUN) ^ count[run].astype(U64))
    return Level(name, x.text[first], lo[first], hi[last])


def compress_pairs(x: Level, p: Piece, round_no: int) -> Level:
    lo, hi, left, right = _neighbours(x, p)
    is_right = (mix(x.name + U64(round_no + 1)) >> U64(63)) == 1
    head = np.zeros(len(x.name), bool)
    head[:-1] = right[:-1] & ~is_right[:-1] & is_right[1:]
    tail = np.zeros(len(x.name), bool)
    tail[1:] = head[:-1]
    # unpaired: a left symbol saw its right neighbour, a right symbol its left one
    new_lo = np.where(~tail & is_right, lo, x.lo)
    new_hi = np.where(~head & ~is_right, hi, x.hi)
    name = x.name.copy()
    at = np.flatnonzero(head)
    name[at] = mix(x.name[at] * PAIR + x.name[at + 1])
    new_hi[at] = x.hi[at + 1]
    keep = ~tail
    return Level(name[keep], x.text[keep], new_lo[keep], new_hi[keep])


def levels(p: Piece, h: np.ndarray, rounds: int) -> list[Level]:
    """Level 0 (words) and the level after each round."""
    out = [words_level(p, h)]
    for r in range(rounds):
        out.append(compress_pairs(compress_runs(out[-1], p), p, r))
    return out


def _range_min(value: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Position of the leftmost least value in [a, b) for each a < b."""
    best = np.arange(len(value))
    table, width = [best], 1
    longest = int((b - a).max(initial=1))
    while 2 * width <= longest:
        x, y = table[-1][:-width], table[-1][width:]
        table.append(np.where(value[y] < value[x], y, x))
        width *= 2
    k = np.frexp((b - a).astype(np.float64))[1] - 1
    out = np.zeros(len(a), np.int64)
    for j in np.unique(k).tolist():
        m = k == j
        x, y = table[j][a[m]], table[j][b[m] - (1 << j)]
        out[m] = np.where(value[y] < value[x], y, x)
    return out


def anchors(p: Piece, h: np.ndarray, window: int, rounds: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, key of each window's anchor).

    A window's anchor is, of the highest level that has any symbol whose whole
    context lies in the window, the one with the least hashed name; its key
    hashes the words of that context.  Windows with no symbol above the words
    (long runs) are their own anchor.  Equal windows have equal keys.
    """
    start = np.flatnonzero(p.whole(window))
    key = np.zeros(len(start), U64)
    todo = np.ones(len(start), bool)
    up, down = hasher.words.get(len(h) + 1)
    total = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up[:len(h)], out=total[1:])
    for depth, x in reversed(list(enumerate(levels(p, h, rounds)))[1:]):
        inside = (x.lo >= p.word0[x.text]) & (x.hi <= p.word0[x.text + 1]) & (x.hi - x.lo <= window)
        lo, hi = x.lo[inside], x.hi[inside]
        if not len(lo) or not todo.any():
            continue
        rank = mix(x.name[inside] ^ U64(depth))
        content = mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(U64))
        s = start[todo]
        # contexts are in order, so those inside a window are consecutive
        a, b = np.searchsorted(lo, s), np.searchsorted(hi, s + window, side="right")
        some = b > a
        at = _range_min(rank, a[some], b[some])
        where = np.flatnonzero(todo)[some]
        key[where] = content[at]
        todo[where] = False
    if todo.any():
        key[todo] = hasher.windows(h, window)[start[todo]]
    return start, key
