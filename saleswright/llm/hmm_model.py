"""A hidden Markov model of symbols: expected counts of Baum-Welch and exact likelihood.

Sequences are taken side by side: one step handles the next symbol of all that are still
running, longest first, so work is in array operations and no step is wasted on padding.
Long sequences are taken in segments that lie side by side too. What a segment sees of the symbols
before and after it comes from the product of each segment's steps, so expected counts are those
of whole sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols of a segment: shorter sequences are one. Changes no count.
SEGMENT = 4096
#: Symbols whose expected counts are held in memory at a time.
CHUNK = 1 << 19
#: Segments whose products are taken side by side.
LANES = 1 << 10


@dataclass
class Hmm:
    start: np.ndarray  # (states): where a sequence begins
    step: np.ndarray  # (states, states): row to column
    emit: np.ndarray  # (symbols, states): columns sum to 1

    @property
    def states(self) -> int:
        return len(self.start)


@dataclass
class Counts:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, symbols: int, states: int) -> Counts:
        return cls(*(np.zeros(n) for n in (states, (states, states), (symbols, states))))


def add_expected(model: Hmm, ids: np.ndarray, ends: np.ndarray, counts: Counts) -> None:
    """Add the expected counts of sequences that lie one after another in ``ids``."""
    ends = np.asarray(ends, dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    per = -(-lengths // SEGMENT)
    row = np.repeat(np.arange(len(ends)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    begin = starts[row] + nth * SEGMENT
    size = np.minimum(ends[row] - begin, SEGMENT)
    first = nth == 0
    before, after = _borders(model, ids, per, begin, size)
    order = np.argsort(-size, kind="stable")
    i = 0
    while i < len(order):
        some = order[i : i + max(1, CHUNK // int(size[order[i]]))]
        _add_segments(
            model, ids, begin[some], size[some], first[some], before[some], after[some], counts
        )
        i += len(some)


def _borders(
    model: Hmm, ids: np.ndarray, per: np.ndarray, begin: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each segment: the states' shares after all symbols before it, and how likely each
    state at its end makes all symbols after it, times a factor that makes the end's shares
    and these add up to 1. ``per`` counts the segments of each sequence."""
    k = model.states
    before, after = np.zeros((len(begin), k)), np.ones((len(begin), k))
    first = np.cumsum(per) - per
    first, per = first[per > 1], per[per > 1]
    if not len(per):
        return before, after
    of = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    segment = np.repeat(first, per) + of
    through = np.zeros((len(begin), k, k))
    through[segment] = _products(model, ids, begin[segment], size[segment], of == 0)
    at_end = np.zeros((len(begin), k))
    ahead = np.tile(model.start, (len(per), 1))
    for j in range(int(per.max())):
        some = per > j
        at = first[some] + j
        before[at] = ahead[some]
        now = np.einsum("ni,nij->nj", ahead[some], through[at])
        ahead[some] = now / now.sum(axis=1, keepdims=True)
        at_end[at] = ahead[some]
    behind = np.ones((len(per), k))
    for j in reversed(range(int(per.max()))):
        some = per > j
        at = first[some] + j
        after[at] = behind[some] / (at_end[at] * behind[some]).sum(axis=1, keepdims=True)
        now = np.einsum("nij,nj->ni", through[at], behind[some])
        behind[some] = now / now.sum(axis=1, keepdims=True)
    return before, after


def _products(
    model: Hmm, ids: np.ndarray, begin: np.ndarray, size: np.ndarray, first: np.ndarray
) -> np.ndarray:
    """For each segment the matrix that leads from shares before it to those at its end, but for
    a factor; a sequence's first segment has no step before its first symbol."""
    k = model.states
    out = np.empty((len(begin), k, k))
    order = np.argsort(-size, kind="stable")
    for i in range(0, len(order), LANES):
        some = order[i : i + LANES]
        lengths, at = size[some], begin[some]
        found = np.tile(np.eye(k), (len(some), 1, 1))
        for t in range(int(lengths[0])):
            m = int(np.searchsorted(-lengths, -t, side="left"))
            ahead = found[:m] @ model.step
            if t == 0:
                ahead[first[some]] = np.eye(k)
            ahead *= model.emit[ids[at[:m] + t]][:, None, :]
            found[:m] = ahead / ahead.sum(axis=(1, 2), keepdims=True)
        out[some] = found
    return out


def _add_segments(model, ids, begin, size, first, before, after, counts) -> None:
    n, k, steps = len(begin), model.states, int(size[0])
    live = np.searchsorted(-size, -np.arange(steps), side="left")  # lanes longer than t
    emit, step = model.emit.astype(np.float32), model.step.astype(np.float32)
    alpha = np.zeros((steps, n, k), dtype=np.float32)
    scale = np.ones((steps, n, 1), dtype=np.float32)
    seen = np.zeros((steps, n), dtype=np.int64)
    prior = np.where(first[:, None], model.start, before @ model.step).astype(np.float32)
    for t in range(steps):
        m = live[t]
        seen[t, :m] = ids[begin[:m] + t]
        ahead = prior if t == 0 else alpha[t - 1, :m] @ step
        now = ahead[:m] * emit[seen[t, :m]]
        scale[t, :m] = now.sum(axis=1, keepdims=True)
        alpha[t, :m] = now / scale[t, :m]
    beta = after.astype(np.float32)
    for t in range(steps - 1, -1, -1):
        m = live[t]
        gamma = alpha[t, :m] * beta[:m]
        gamma /= gamma.sum(axis=1, keepdims=True)
        here = emit[seen[t, :m]] * beta[:m] / scale[t, :m]
        if t:
            counts.step += (alpha[t - 1, :m].T @ here) * step
            beta[:m] = here @ step.T
        else:
            counts.start += gamma[first].sum(axis=0)
            counts.step += (before[~first].T @ here[~first]) * step
        alpha[t, :m] = gamma
    flat = np.concatenate([seen[t, : live[t]] for t in range(steps)])
    weight = np.concatenate([alpha[t, : live[t]] for t in range(steps)])
    for state in range(k):
        counts.emit[:, state] += np.bincount(
            flat, weights=weight[:, state], minlength=len(counts.emit)
        )


def refined(counts: Counts, background: np.ndarray, share: float = 0.01) -> Hmm:
    """The model of summed counts; each state emits by ``share`` as the corpus as a whole does,
    so nothing has probability 0."""

    def spread(x: np.ndarray) -> np.ndarray:
        return (x + 1) / (x + 1).sum(axis=-1, keepdims=True)

    total = counts.emit.sum(axis=0)
    own = np.where(total > 0, counts.emit / np.maximum(total, 1e-300), background[:, None])
    emit = (1 - share) * own + share * background[:, None]
    return Hmm(spread(counts.start), spread(counts.step), emit)


def log10_likelihood(model: Hmm, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of each whole sequence, by the scaled forward recursion."""
    ends = np.asarray(ends, dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    begin, size = starts[order], size[order]
    total = np.zeros(len(begin))
    steps = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(steps), side="left")
    alpha = np.tile(model.start, (len(begin), 1))
    for t in range(steps):
        m = live[t]
        ahead = alpha[:m] if t == 0 else alpha[:m] @ model.step
        now = ahead * model.emit[ids[begin[:m] + t]]
        scale = now.sum(axis=1)
        total[:m] += np.log10(scale)
        alpha[:m] = now / scale[:, None]
    result = np.empty(len(begin))
    result[order] = total
    return result


def word_clusters(together: np.ndarray, n_docs: int, states: int) -> np.ndarray:
    """A cluster for each of the frequent words, from the number of documents that each two of
    them share: words that keep the same company. Deterministic farthest-first k-means."""
    own = np.maximum(np.diag(together).astype(np.float64), 1)
    expected = own[:, None] * own[None, :] / max(n_docs, 1)
    points = np.maximum(np.log((together + 0.1) / (expected + 0.1)), -3)
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    states = min(states, len(points))
    chosen = [int(np.argmax(own))]
    while len(chosen) < states:
        near = (points @ points[chosen].T).max(axis=1)
        chosen.append(int(np.argmin(near)))
    centers = points[chosen]
    for _ in range(20):
        group = (points @ centers.T).argmax(axis=1)
        for g in range(states):
            if (group == g).any():
                centers[g] = points[group == g].mean(axis=0)
    return group


def first_model(background: np.ndarray, group: np.ndarray, states: int) -> Hmm:
    """States that last, each of which emits one cluster of the frequent words far more often."""
    emit = np.tile(background[:, None], (1, states))
    boost = np.full((len(group), states), 0.05)
    boost[np.arange(len(group)), group] = 1.0
    emit[: len(group)] *= boost
    for state in range(states):
        if state not in group:  # more states than clusters: tell them apart by some noise
            noise = np.random.default_rng(state).uniform(0.5, 1.5, len(emit))
            emit[:, state] = background * noise
    emit /= emit.sum(axis=0)
    step = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(step, 0.95)
    step /= step.sum(axis=1, keepdims=True)
    even = np.full(states, 1 / states)
    return Hmm(even, step, emit)
