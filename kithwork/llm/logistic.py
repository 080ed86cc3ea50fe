"""Logistic regression on a small dense sample, by Newton steps with a ridge."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, steps: int = 60) -> np.ndarray:
    """Weights for the columns of ``x`` and an intercept in the last place."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(z @ w)
        slope = z.T @ (weight * (p - y)) + penalty * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    scaled = w[:-1] / spread
    return np.append(scaled, w[-1] - (scaled * mean).sum())
