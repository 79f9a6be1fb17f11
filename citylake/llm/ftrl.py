"""Sparse multinomial logistic regression by follow-the-regularised-leader.

The per-coordinate update of FTRL-proximal with elastic-net penalties, over small batches
of rows of a bounded sample; weights are computed only for the features of a batch.
"""

from __future__ import annotations

import numpy as np


def summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of `values` by place; bincount alone would give whole numbers for no values."""
    return np.bincount(at, values, size).astype(np.float64)


class Rows:
    """Sparse rows: feature numbers and values, end to end."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, features), np.int64, len(features))
        self.edges = np.concatenate(([0], np.cumsum(self.sizes)))
        self.features = np.concatenate([*features, np.zeros(0, np.int64)]).astype(np.int64)
        self.values = np.concatenate([*values, np.zeros(0)]).astype(np.float64)

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, values and the place in `rows` of every entry of these rows."""
        sizes = self.sizes[rows]
        at = np.repeat(self.edges[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return self.features[at], self.values[at], np.repeat(np.arange(len(rows)), sizes)


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


class Ftrl:
    """Weights (features + 1) x classes; the last row is the intercept."""

    def __init__(self, n_features: int, n_classes: int, rate=0.5, smooth=1.0, l1=0.0, l2=0.0):
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2
        self.z = np.zeros((n_features + 1, n_classes))
        self.n = np.zeros((n_features + 1, n_classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        scale = (self.smooth + np.sqrt(n)) / self.rate + self.l2
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / scale, 0.0)

    def fit(self, rows: Rows, labels: np.ndarray, epochs: int = 4, batch: int = 32, seed: int = 7) -> Ftrl:
        order, rng = np.arange(len(rows)), np.random.default_rng(seed)
        classes = self.z.shape[1]
        for _ in range(epochs):
            rng.shuffle(order)
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                features, values, which = rows.take(part)
                used, place = np.unique(np.append(features, len(self.z) - 1), return_inverse=True)
                place, w = place[:-1], self.weights(used)
                scores = np.stack(
                    [summed(which, values * w[place, c], len(part)) for c in range(classes)], axis=1
                )
                miss = softmax(scores + w[-1])
                miss[np.arange(len(part)), labels[part]] -= 1
                g = np.stack(
                    [summed(place, values * miss[which, c], len(used)) for c in range(classes)], axis=1
                )
                g[-1] += miss.sum(axis=0)
                root = np.sqrt(self.n[used])
                self.n[used] += g * g
                self.z[used] += g - (np.sqrt(self.n[used]) - root) / self.rate * w
        return self

    def scores(self, rows: Rows) -> np.ndarray:
        w = self.weights()
        features, values, which = rows.take(np.arange(len(rows)))
        out = [summed(which, values * w[features, c], len(rows)) for c in range(w.shape[1])]
        return np.stack(out, axis=1) + w[-1]
