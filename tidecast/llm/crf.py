"""Linear-chain conditional random fields over many sequences at once, in numpy.

Sequences of different lengths lie one after another. Inside, they are ordered by length and
laid out by time step, so a step handles all sequences that are still running at once and no
cell is padding. Memory is linear in the number of items.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class _Steps:
    """Places of items by time step; ``running[t]`` sequences take the places from ``first[t]``."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, "int64")
        rank = np.empty(len(lengths), "int64")
        rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
        longest = int(lengths.max(initial=0))
        self.running = len(lengths) - np.cumsum(np.bincount(lengths, minlength=longest + 1))[:longest]
        self.first = np.concatenate([[0], np.cumsum(self.running)])
        time = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.first[time] + np.repeat(rank, lengths)

    def spread(self, items: np.ndarray) -> np.ndarray:
        out = np.empty_like(items)
        out[self.place] = items
        return out

    def at(self, t: int, running: int | None = None) -> slice:
        return slice(self.first[t], self.first[t] + (self.running[t] if running is None else running))


def marginals(
    scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, pairs: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: each item's label probabilities, and the expected counts of label pairs (zero if not wanted)."""
    steps = _Steps(lengths)
    e = steps.spread(np.exp(scores - scores.max(axis=1, keepdims=True, initial=-1e9)))
    a, alpha, beta = np.exp(moves), np.empty_like(e), np.ones_like(e)
    expected = np.zeros_like(a)
    for t, n in enumerate(steps.running):
        now = steps.at(t)
        alpha[now] = e[now] if not t else (alpha[steps.at(t - 1, n)] @ a) * e[now]
        alpha[now] /= alpha[now].sum(axis=1, keepdims=True)
    for t in range(len(steps.running) - 1, 0, -1):
        n = steps.running[t]
        ahead = e[steps.at(t)] * beta[steps.at(t)]
        back = ahead @ a.T
        if pairs:
            before = alpha[steps.at(t - 1, n)]
            expected += (before / (before * back).sum(axis=1, keepdims=True)).T @ ahead
        beta[steps.at(t - 1, n)] = back / back.sum(axis=1, keepdims=True)
    alpha *= beta
    alpha /= alpha.sum(axis=1, keepdims=True)
    return alpha[steps.place], expected * a


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The most probable labels of all sequences, as one array; the smaller label on a tie."""
    steps = _Steps(lengths)
    e = steps.spread(scores)
    best, came = np.empty_like(e), np.zeros(e.shape, "int8")
    for t, n in enumerate(steps.running):
        now = steps.at(t)
        if not t:
            best[now] = e[now]
            continue
        reach = best[steps.at(t - 1, n)][:, :, None] + moves
        came[now] = reach.argmax(axis=1)
        best[now] = reach.max(axis=1) + e[now]
        best[now] -= best[now].max(axis=1, keepdims=True)
    labels = np.empty(len(e), "int8")
    ahead = np.zeros(0, "int8")
    for t in range(len(steps.running) - 1, -1, -1):
        now = best[steps.at(t)].argmax(axis=1).astype("int8")
        now[: len(ahead)] = ahead
        labels[steps.at(t)] = now
        ahead = came[steps.at(t)][np.arange(len(now)), now] if t else ahead
    return labels[steps.place]


def fit(
    score: Callable[[np.ndarray], np.ndarray],
    pull: Callable[[np.ndarray], np.ndarray],
    shape: tuple[int, int],
    labels: np.ndarray,
    lengths: np.ndarray,
    rounds: int = 40,
    rate: float = 0.1,
    l2: float = 1e-6,
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood by Adam: the feature weights and the label moves.

    ``score`` gives the items' label scores under weights, ``pull`` the weights' gradient
    from that of the scores.
    """
    states = shape[1]
    params = [np.zeros(shape, "float64"), np.zeros((states, states), "float64")]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    truth = np.eye(states)[labels]
    inner = np.ones(len(labels), bool)
    inner[(np.cumsum(lengths) - lengths)[np.asarray(lengths) > 0]] = False
    seen = np.zeros((states, states))
    at = np.flatnonzero(inner)
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    total = max(1, len(labels))
    for k in range(1, rounds + 1):
        expected, pairs = marginals(score(params[0]), lengths, params[1])
        slopes = [pull(truth - expected) / total - l2 * params[0], (seen - pairs) / total - l2 * params[1]]
        for p, g, m, s in zip(params, slopes, mean, square):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p += rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-9)
    return params[0], params[1]
