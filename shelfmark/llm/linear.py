"""Logistic regression on a bounded sample, by accelerated proximal gradient."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(
    forward: Callable[[np.ndarray], np.ndarray],
    backward: Callable[[np.ndarray], np.ndarray],
    y: np.ndarray,
    width: int,
    lipschitz: float,
    l1: float = 0.0,
    l2: float = 0.0,
    rounds: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the minimum of mean log loss + l1 |w| + l2 |w|² / 2.

    ``forward(w)`` is X w and ``backward(r)`` is X' r, so X may be dense or sparse.
    ``lipschitz`` bounds the largest eigenvalue of X' X / n, intercept column included.
    The intercept is not penalised. Without rows, or with one class only, the weights
    are zero and the intercept is the smoothed log odds.
    """
    n = len(y)
    positive = float(y.sum())
    intercept = float(np.log((positive + 1.0) / (n - positive + 1.0)))
    w = np.zeros(width)
    if n == 0 or positive in (0.0, float(n)) or width == 0:
        return w, intercept
    step = 1.0 / (lipschitz / 4.0 + l2)
    ahead_w, ahead_b, momentum = w.copy(), intercept, 1.0
    for _ in range(rounds):
        error = (sigmoid(forward(ahead_w) + ahead_b) - y) / n
        moved = ahead_w - step * (backward(error) + l2 * ahead_w)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0.0)
        new_b = ahead_b - step * float(error.sum())
        following = (1.0 + np.sqrt(1.0 + 4.0 * momentum * momentum)) / 2.0
        ahead_w = new_w + (momentum - 1.0) / following * (new_w - w)
        ahead_b = new_b + (momentum - 1.0) / following * (new_b - intercept)
        w, intercept, momentum = new_w, new_b, following
    return w, intercept
