"""Logistic models on sparse rows, fitted on bounded samples."""

from __future__ import annotations

from collections import deque
from typing import NamedTuple

import numpy as np


class Rows(NamedTuple):
    """Sparse rows: ``columns`` and ``values`` of row i lie between ``bounds[i]`` and the next."""

    bounds: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], values: list[np.ndarray] | None = None) -> Rows:
        bounds = np.concatenate(([0], np.cumsum([len(row) for row in rows]))).astype(np.int64)
        columns = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        held = np.ones(len(columns)) if values is None else np.concatenate(values or [np.zeros(0)])
        return cls(bounds, columns.astype(np.int64), held.astype(np.float64))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def times(self, weights: np.ndarray) -> np.ndarray:
        products = weights[self.columns] * self.values
        # Without any value the counts would be integers.
        return np.bincount(self.owners(), products, minlength=len(self)).astype(np.float64)

    def pick(self, chosen: np.ndarray) -> Rows:
        """The rows that the boolean array names."""
        inside = np.repeat(chosen, np.diff(self.bounds))
        lengths = np.diff(self.bounds)[chosen]
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return Rows(bounds, self.columns[inside], self.values[inside])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(
    rows: Rows, extra: np.ndarray, target: np.ndarray, width: int, l2: float = 1.0, steps: int = 60
) -> np.ndarray:
    """Weights of ``width`` columns, of the dense ``extra`` ones, and a bias in the end.

    Minimises the log loss against ``target`` (0 to 1) with an L2 penalty, by L-BFGS. With
    targets all alike, or none, only the bias says so.
    """
    m = extra.shape[1]
    size = width + m + 1
    weights = np.zeros(size)
    if not len(target) or target.min() == target.max():
        mean = target.mean() if len(target) else 0.0
        weights[-1] = np.log((mean + 1e-4) / (1 - mean + 1e-4))
        return weights
    owners = rows.owners()

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.times(w) + extra @ w[width : width + m] + w[-1]
        error = sigmoid(z) - target
        slope = np.empty(size)
        slope[:width] = np.bincount(rows.columns, error[owners] * rows.values, minlength=width)
        slope[width : width + m] = extra.T @ error
        slope[-1] = error.sum()
        slope[:-1] += l2 * w[:-1]
        total = (np.logaddexp(0, z) - target * z).sum() + l2 / 2 * (w[:-1] @ w[:-1])
        return float(total), slope

    now, slope = loss(weights)
    memory: deque = deque(maxlen=8)
    for _ in range(steps):
        direction, used = slope.copy(), []
        for s, y, scale in reversed(memory):
            a = scale * (s @ direction)
            used.append(a)
            direction -= a * y
        if memory:
            s, y, _ = memory[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(np.abs(slope).max(), 1.0)
        for (s, y, scale), a in zip(memory, reversed(used), strict=True):
            direction += s * (a - scale * (y @ direction))
        step, down = 1.0, slope @ direction
        while True:
            tried = weights - step * direction
            value, after = loss(tried)
            if value <= now - 1e-4 * step * down or step < 1e-6:
                break
            step /= 2
        s, y = tried - weights, after - slope
        if s @ y > 1e-12:
            memory.append((s, y, 1 / (s @ y)))
        weights, slope, gain, now = tried, after, now - value, value
        if gain < 1e-7 * max(1.0, abs(now)):
            break
    return weights


def predict(rows: Rows, extra: np.ndarray, weights: np.ndarray) -> np.ndarray:
    width = len(weights) - extra.shape[1] - 1
    return sigmoid(rows.times(weights[:width]) + extra @ weights[width:-1] + weights[-1])
