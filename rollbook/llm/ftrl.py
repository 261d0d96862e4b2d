"""FTRL-proximal: per-coordinate rates, with an elastic net that keeps weights sparse."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Weights of ``n_features`` x ``n_outputs``; the last row is the intercept, which
    is not penalised.  Only the rows of an example's features are touched."""

    def __init__(self, n_features: int, n_outputs: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((n_features + 1, n_outputs), np.float32)
        self.n = np.zeros((n_features + 1, n_outputs), np.float32)
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = np.full((n_features + 1, 1), l1, np.float32)
        self.l1[-1] = 0

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        pulled = np.sign(z) * np.maximum(np.abs(z) - self.l1[rows], 0)
        return -pulled / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, rows: np.ndarray, x: np.ndarray, target: np.ndarray) -> None:
        """One example: distinct feature rows (the intercept's last, with x 1), their
        values, and the wanted output probabilities."""
        w = self.weights(rows)
        gradient = x[:, None] * (probability(x @ w) - target)[None, :]
        squared = gradient * gradient
        before = self.n[rows]
        rate = (np.sqrt(before + squared) - np.sqrt(before)) / self.alpha
        self.z[rows] += gradient - rate * w
        self.n[rows] = before + squared


def probability(logits: np.ndarray) -> np.ndarray:
    """Sigmoid of one output, softmax of several (along the last axis)."""
    if logits.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits that makes held-back labels most likely: golden-section
    search over its logarithm, in which the likelihood has one peak."""

    def loss(log_t: float) -> float:
        p = probability(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
