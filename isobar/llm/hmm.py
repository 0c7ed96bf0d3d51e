"""Hidden Markov model over symbol sequences, in numpy: Baum-Welch sums and the scaled forward recursion.

Sequences of a batch advance together, one step at a time, longest first, so a
step is a few array operations over all sequences that are that long.  A long
text advances in pieces side by side: each piece is first summed up as a K x K
matrix, the matrices are multiplied along the text, and so every piece knows
the states' chances at both of its ends.  Nothing is lost at a cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Steps between two scalings: chances of this many symbols in a row stay far from underflow.
RESCALE = 8


@dataclass
class Model:
    start: np.ndarray     # (K,)
    move: np.ndarray      # (K, K), rows sum to 1
    emit: np.ndarray      # (symbols, K), columns sum to 1

    @classmethod
    def seeded(cls, unigram: np.ndarray, states: int, stay: float, spread: float, seed: int) -> Model:
        """States that each favour a random set of symbols, to start training from."""
        r = np.random.default_rng(seed)
        emit = unigram[:, None] * np.exp(spread * r.standard_normal((len(unigram), states)))
        move = np.full((states, states), (1 - stay) / max(states - 1, 1))
        np.fill_diagonal(move, stay if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    def improved(self, starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, unigram: np.ndarray, prior: float) -> Model:
        """The next model from expected counts; symbols a state has not seen fall back on the unigram."""
        k = len(self.start)
        return Model((starts + 1) / (starts.sum() + k),
                     (moves + 1) / (moves.sum(axis=1, keepdims=True) + k),
                     (emits + prior * unigram[:, None]) / (emits.sum(axis=0) + prior))


def by_step(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols by step, first index of each step, order): the steps' symbols lie end to end, longest sequence first."""
    length = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-length, kind="stable")
    steps = int(length.max(initial=0))
    alive = len(length) - np.searchsorted(np.sort(length), np.arange(steps), side="right")
    first = np.concatenate([[0], np.cumsum(alive)])
    out = np.empty(int(first[-1]), np.int64)
    for rank, i in enumerate(order.tolist()):
        out[first[:length[i]] + rank] = sequences[i]
    return out, first, order


def log10_likelihood(m: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each sequence by the scaled forward recursion."""
    symbols, first, order = by_step(sequences)
    total, one, at = np.zeros(len(sequences)), np.ones(len(m.start)), first.tolist()
    state = np.tile(m.start, (len(sequences), 1))
    for t in range(len(at) - 1):
        n = at[t + 1] - at[t]
        state = state[:n] if t == 0 else state[:n] @ m.move
        state *= m.emit.take(symbols[at[t]:at[t + 1]], axis=0)
        on = at[t + 2] - at[t + 1] if t + 2 < len(at) else 0  # sequences that go on
        ends = 0 if t % RESCALE == RESCALE - 1 else on
        if ends < n:
            scale = state[ends:] @ one
            state[ends:] /= scale[:, None]
            total[ends:n] += np.log10(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


@dataclass
class Parts:
    """Sequences, and the states' chances at their ends."""

    sequences: list[np.ndarray]
    prior: np.ndarray     # (n, K), chances before the first symbol is seen
    before: np.ndarray    # (n, K), chances at the token before, all 0 where a text opens
    leave: np.ndarray     # (n, K), backward vectors at the last token, scaled as chances x leave = 1

    @classmethod
    def whole(cls, m: Model, sequences: list[np.ndarray]) -> Parts:
        shape = (len(sequences), len(m.start))
        return cls(sequences, np.broadcast_to(m.start, shape), np.zeros(shape), np.ones(shape))

    def part(self, a: int, b: int) -> Parts:
        return Parts(self.sequences[a:b], self.prior[a:b], self.before[a:b], self.leave[a:b])

    @classmethod
    def together(cls, parts: list[Parts]) -> Parts:
        return cls([s for p in parts for s in p.sequences], np.vstack([p.prior for p in parts]),
                   np.vstack([p.before for p in parts]), np.vstack([p.leave for p in parts]))


def transfers(m: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n, K, K) matrices from the chances before a sequence to those at its end, and the log10 of their scales."""
    k = len(m.start)
    symbols, first, order = by_step(sequences)
    q, log = np.tile(np.eye(k), (len(sequences), 1, 1)), np.zeros(len(sequences))
    for t in range(len(first) - 1):
        a, b = first[t], first[t + 1]
        now = q[:b - a]
        if t:
            now = (now.reshape(-1, k) @ m.move).reshape(-1, k, k)
        now = now * m.emit[symbols[a:b]][:, None, :]
        if t % 8 == 7 or t == len(first) - 2 or b - a > first[t + 2] - b:  # at times, and where a sequence ends
            scale = now.sum(axis=(1, 2))
            now /= scale[:, None, None]
            log[:b - a] += np.log10(scale)
        q[:b - a] = now
    out, out_log = np.empty_like(q), np.empty_like(log)
    out[order], out_log[order] = q, log
    return out, out_log


def cut_up(m: Model, texts: list[np.ndarray], cut: int, group: int) -> Iterator[tuple[Parts, float]]:
    """Each text as pieces of ``cut`` tokens with exact ends, and its log10 probability.

    ``group`` pieces of all texts are summed up at a time, so memory beyond the
    texts' own is K x K numbers a piece.
    """
    cuts = [[s[a:a + cut] for a in range(0, len(s), cut)] for s in texts]
    flat = [c for s in cuts for c in s]
    found = [transfers(m, flat[a:a + group]) for a in range(0, len(flat), group)]
    every, logs = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    k, at = len(m.start), 0
    for pieces in cuts:
        n = len(pieces)
        q, total = every[at:at + n], float(logs[at:at + n].sum())
        at += n
        prior, last, leave = np.empty((n, k)), np.empty((n, k)), np.ones((n, k))
        chance = m.start
        for i in range(n):
            prior[i] = chance
            ahead = chance @ q[i]
            total += float(np.log10(ahead.sum()))
            last[i] = ahead / ahead.sum()
            chance = last[i] @ m.move
        for i in range(n - 1, 0, -1):
            back = m.move @ (q[i] @ leave[i])
            leave[i - 1] = back / (last[i - 1] @ back)
        yield Parts(pieces, prior, np.vstack([np.zeros((1, k)), last[:-1]]), leave), total


def expected_counts(m: Model, parts: Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch sums (starts, moves, emits) over the sequences, the moves into them included.

    Chances are scaled to sum to 1 every RESCALE steps and where a sequence
    ends; the emissions of these steps take the scale, so the backward pass
    meets the same one.
    """
    k = len(m.start)
    symbols, first, order = by_step(parts.sequences)
    steps = len(first) - 1
    moves, emits = np.zeros((k, k)), np.zeros((len(m.emit), k))
    if not steps:
        return np.zeros(k), moves, emits
    before, leave = parts.before[order], parts.leave[order]
    opening = ~before.any(axis=1)
    one, back_moves, at = np.ones(k), np.ascontiguousarray(m.move.T), first.tolist()
    seen = m.emit.take(symbols, axis=0)
    ahead, back = np.empty_like(seen), np.empty_like(seen)
    for t in range(steps):
        a, b = at[t], at[t + 1]
        now = ahead[a:b]
        if t:
            np.matmul(ahead[at[t - 1]:at[t - 1] + b - a], m.move, out=now)
        else:
            now[:] = parts.prior[order][:b]
        now *= seen[a:b]
        on = at[t + 2] - b if t + 1 < steps else 0  # sequences that go on
        ends = 0 if t % RESCALE == RESCALE - 1 else on
        if ends < b - a:
            share = (1 / (now[ends:] @ one))[:, None]
            now[ends:] *= share
            seen[a + ends:b] *= share
    for t in range(steps - 1, -1, -1):
        a, b = at[t], at[t + 1]
        on = at[t + 2] - b if t + 1 < steps else 0
        here = back[a:b]
        here[on:] = leave[on:b - a]
        if on:
            later = seen[b:b + on]  # seen has become emission x backward there
            moves += ahead[a:a + on].T @ later
            np.matmul(later, back_moves, out=here[:on])
        seen[a:b] *= here
    n = at[1]
    moves += before.T @ seen[:n]
    moves *= m.move
    ahead *= back  # the state probabilities
    for j in range(k):
        emits[:, j] = np.bincount(symbols, weights=ahead[:, j], minlength=len(m.emit))
    return ahead[:n][opening].sum(axis=0), moves, emits
