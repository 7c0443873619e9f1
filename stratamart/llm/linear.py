"""Linear classifiers on sparse rows: a bounded sample fitted by accelerated gradient descent, or all rows of a table,
each evaluation one pass by its tasks, by L-BFGS."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import numpy as np


@dataclass
class Rows:
    """Sparse rows: row i has ``values[offsets[i]:offsets[i + 1]]`` in the columns ``index[...]``."""

    index: np.ndarray
    values: np.ndarray
    offsets: np.ndarray
    width: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.values * weights[self.index], dtype=np.float64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def transposed_times(self, per_row: np.ndarray) -> np.ndarray:
        spread = np.repeat(per_row, np.diff(self.offsets))
        return np.bincount(self.index, weights=self.values * spread, minlength=self.width)


def _slopes(loss: str, margins: np.ndarray) -> np.ndarray:
    if loss == "logistic":
        return -1 / (1 + np.exp(np.clip(margins, -500, 500)))
    return -2 * np.maximum(1 - margins, 0)  # squared hinge


def fit(rows: Rows, sides: np.ndarray, loss: str, penalty: float = 1e-4, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias for sides of +1 and -1; both sides weigh the same in all. ``loss``: logistic or squared_hinge."""
    share = np.where(sides > 0, 0.5 / max((sides > 0).sum(), 1), 0.5 / max((sides < 0).sum(), 1))
    curve = 0.25 if loss == "logistic" else 2.0
    # the largest curvature of the mean loss is at most that of the widest row
    squares = np.concatenate([[0.0], np.cumsum(rows.values.astype(np.float64) ** 2)])
    rate = 1 / (curve * np.sum(share * (squares[rows.offsets[1:]] - squares[rows.offsets[:-1]] + 1)) + penalty)
    weights, bias = np.zeros(rows.width), 0.0
    ahead, ahead_bias, momentum = weights, bias, 1.0
    for _ in range(steps):
        slope = _slopes(loss, sides * (rows.times(ahead) + ahead_bias)) * sides * share
        new = ahead - rate * (rows.transposed_times(slope) + penalty * ahead)
        new_bias = ahead_bias - rate * slope.sum()
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / faster
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias, momentum = new, new_bias, faster
    return weights, float(bias)


class Passes(Protocol):
    """Rows that stay where they are: one pass gives the loss, its slope in each column, and its slope in the bias."""

    width: int

    def evaluate(self, weights: np.ndarray, bias: float, shares: dict[int, float]) -> tuple[float, np.ndarray, float]: ...


def lowest(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], width: int, steps: int, memory: int = 6, enough: float = 1e-3) -> np.ndarray:
    """Where a smooth convex function is lowest, from 0, in at most ``steps`` evaluations of it and its slope; ends before
    when the slope is ``enough`` of the first. L-BFGS with halving of steps that do not descend."""
    point, pairs = np.zeros(width), deque(maxlen=memory)
    value, slope = evaluate(point)
    first, used = np.linalg.norm(slope), 1
    while used < steps and np.linalg.norm(slope) > enough * first:
        direction, shares = -slope, []
        for moved, turned, inverse in reversed(pairs):
            shares.append(inverse * (moved @ direction))
            direction = direction - shares[-1] * turned
        if pairs:
            moved, turned, inverse = pairs[-1]
            direction = direction / (inverse * (turned @ turned))
        for (moved, turned, inverse), share in zip(pairs, reversed(shares)):
            direction = direction + (share - inverse * (turned @ direction)) * moved
        rate = 1.0 if pairs else 1 / first
        while True:
            new = point + rate * direction
            new_value, new_slope = evaluate(new)
            used += 1
            if new_value <= value + 1e-4 * rate * (slope @ direction):
                break
            if used >= steps:
                return point
            rate /= 2
        moved, turned = new - point, new_slope - slope
        if moved @ turned > 1e-12:
            pairs.append((moved.astype(np.float32), turned.astype(np.float32), 1 / (moved @ turned)))
        point, value, slope = new, new_value, new_slope
    return point


def fit_passes(rows: Passes, sides: np.ndarray, penalty: float = 1e-5, steps: int = 40) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic loss, as ``fit`` has them, for all rows of ``rows``, whose sides are ``sides``."""
    shares = {side: 0.5 / max(int((sides == side).sum()), 1) for side in (1, -1)}

    def evaluate(at: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slopes, bias_slope = rows.evaluate(at[:-1], at[-1], shares)
        return loss + penalty / 2 * (at[:-1] @ at[:-1]), np.append(slopes + penalty * at[:-1], bias_slope)

    found = lowest(evaluate, rows.width + 1, steps)
    return found[:-1], float(found[-1])
