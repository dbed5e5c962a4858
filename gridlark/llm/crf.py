"""Linear-chain conditional random field over batches of equally long sequences."""

from __future__ import annotations

import numpy as np


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradients(emissions: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood, and its gradients by emissions and by transitions.

    ``emissions`` is (sequences, length, tags), ``moves`` (from, to), ``tags`` the truth.
    """
    n, length, k = emissions.shape
    ahead = np.empty((n, length, k))
    behind = np.zeros((n, length, k))
    ahead[:, 0] = emissions[:, 0]
    for t in range(1, length):
        ahead[:, t] = emissions[:, t] + _logsumexp(ahead[:, t - 1, :, None] + moves, 1)
    for t in range(length - 2, -1, -1):
        behind[:, t] = _logsumexp(moves + (emissions[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = _logsumexp(ahead[:, -1], 1)
    share = np.exp(ahead + behind - total[:, None, None])
    rows, places = np.arange(n)[:, None], np.arange(length)
    truth = emissions[rows, places, tags].sum() + moves[tags[:, :-1], tags[:, 1:]].sum()
    by_emission = share
    by_emission[rows, places, tags] -= 1
    pairs = ahead[:, :-1, :, None] + moves + (emissions[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
    by_move = np.exp(pairs).sum(axis=(0, 1))
    np.add.at(by_move, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    return float(total.sum() - truth) / n, by_emission / n, by_move / n


def viterbi(emissions: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The likeliest tags of each sequence; ties go to the lower tag."""
    n, length, k = emissions.shape
    best, back = emissions[:, 0], np.zeros((n, length, k), np.int64)
    for t in range(1, length):
        ways = best[:, :, None] + moves
        back[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + emissions[:, t]
    tags = np.empty((n, length), np.int64)
    tags[:, -1] = best.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


class Adam:
    """Adam steps on a dictionary of arrays."""

    def __init__(self, values: dict[str, np.ndarray], rate: float) -> None:
        self.values, self.rate, self.steps = values, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in values.items()}
        self.square = {k: np.zeros_like(v) for k, v in values.items()}

    def step(self, by: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for k, g in by.items():
            self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
            self.square[k] = 0.99 * self.square[k] + 0.01 * g * g
            mean = self.mean[k] / (1 - 0.9**self.steps)
            self.values[k] -= self.rate * mean / (np.sqrt(self.square[k] / (1 - 0.99**self.steps)) + 1e-8)
