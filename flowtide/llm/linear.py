"""Logistic regression on sparse rows, and calibration of its scores."""

from __future__ import annotations

import numpy as np

ROUNDS = 60
RATE = 0.3
RIDGE = 1e-4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Rows of (slot, value) pairs, end to end."""

    def __init__(self, slot: np.ndarray, value: np.ndarray, row: np.ndarray, rows: int):
        self.slot, self.value, self.row, self.rows = slot, value, row, rows

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.slot] * self.value, minlength=self.rows)

    def back(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slot, by_row[self.row] * self.value, minlength=size)

    def pick(self, chosen: np.ndarray) -> Sparse:
        """The rows for which ``chosen`` holds, in order."""
        place = np.cumsum(chosen) - 1
        keep = chosen[self.row]
        return Sparse(self.slot[keep], self.value[keep], place[self.row[keep]], int(chosen.sum()))


def fit_logistic(
    x: Sparse, y: np.ndarray, size: int, rounds: int = ROUNDS, rate: float = RATE, ridge: float = RIDGE
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradients with per-coordinate rates.

    A label between 0 and 1 is a chance: the row counts for both classes in these parts. Classes weigh the
    same in sum. With one class only, or no rows, the weights are zero and the bias says that class (or nothing).
    """
    weights, bias = np.zeros(size), 0.0
    positive = float(y.sum())
    if not 0 < positive < len(y):
        return weights, 4.0 * (1 if positive else -1) if len(y) else 0.0
    good, bad = y * (0.5 / positive), (1 - y) * (0.5 / (len(y) - positive))
    seen, seen_bias = np.full(size, 1e-8), 1e-8
    for _ in range(rounds):
        p = sigmoid(x.times(weights) + bias)
        error = (p - 1) * good + p * bad
        step = x.back(error, size) + ridge * weights / size
        seen += step * step
        weights -= rate * step / np.sqrt(seen)
        change = float(error.sum())
        seen_bias += change * change
        bias -= rate * change / seen_bias**0.5
    return weights, bias


def fit_scale(score: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Platt scaling: slope and shift that make ``sigmoid(slope * score + shift)`` a
    probability, by Newton steps on smoothed targets. Too few rows leave the score as it is."""
    positive, total = float(y.sum()), len(y)
    if not 0 < positive < total:
        return 1.0, 0.0
    goal = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (total - positive + 2))
    spread = float(score.std()) or 1.0
    design = np.stack([score / spread, np.ones(total)])
    beta = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(beta @ design)
        slope = design @ (p - goal) + 1e-3 * beta
        bend = (design * (p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        beta -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    if beta[0] <= 0:  # a score that says nothing: the base rate alone
        return 0.0, float(np.log(positive / (total - positive)))
    return float(beta[0] / spread), float(beta[1])
