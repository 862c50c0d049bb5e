"""A small logistic regression for bounded training samples."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Standardized features, weights for rows, a ridge penalty, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0):
        x, y = np.asarray(x, float), np.asarray(y, float)
        weight = np.ones(len(y)) if weight is None else np.asarray(weight, float)
        self.mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
        self.scale = np.where((s := x.std(0)) > 1e-9, s, 1.0) if len(x) else np.ones(x.shape[1])
        self.coef = np.zeros(x.shape[1] + 1)
        if not len(x):
            return
        z = self._design(x)
        penalty = np.diag([1e-6] + [ridge] * x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.coef, -35, 35)))
            slope = z.T @ (weight * (p - y)) + penalty @ self.coef
            step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + penalty, slope)
            self.coef -= np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._design(np.asarray(x, float)) @ self.coef

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))
