"""Multinomial logistic regression on sparse rows, trained by follow-the-regularised-leader with elastic-net penalties."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature numbers, values


@dataclass
class Softmax:
    """Scores of ``labels``: features x weights + bias, divided by the temperature."""

    labels: list
    weights: np.ndarray  # labels x features
    bias: np.ndarray
    temperature: float = 1.0

    def parts(self) -> tuple:
        """What a broadcast carries: plain values, from which ``Softmax(*parts)`` is made again."""
        return self.labels, self.weights, self.bias, self.temperature

    def logits(self, row: Row) -> np.ndarray:
        at, x = row
        return self.weights[:, at] @ x + self.bias

    def chances(self, row: Row) -> np.ndarray:
        return softmax(self.logits(row) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate state of the proximal update; weights follow from it, most of them zero."""

    def __init__(self, n_labels: int, n_features: int, rate: float, beta: float, l1: float, l2: float):
        self.rate, self.beta, self.l1, self.l2 = rate, beta, l1, l2
        self.z, self.n = np.zeros((n_labels, n_features)), np.zeros((n_labels, n_features))

    def weights(self, at=slice(None), l1: float | None = None) -> np.ndarray:
        z, n, l1 = self.z[:, at], self.n[:, at], self.l1 if l1 is None else l1
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.rate + self.l2))

    def update(self, at, gradient: np.ndarray, w: np.ndarray) -> None:
        n = self.n[:, at]
        grown = n + gradient**2
        self.z[:, at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.rate * w
        self.n[:, at] = grown


def train(rows: list[Row], y: list[int], labels: list, n_features: int, *, epochs: int = 5, rate: float = 0.3, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.01, held: float = 0.2, seed: int = 7) -> Softmax:
    """Fit on all but every ``1/held``-th row, which calibrate the temperature. The bias is not penalised by l1.

    The outcome depends on the rows and their order alone.
    """
    n_held = int(len(rows) * held) if len(rows) * held >= len(labels) * 10 else 0
    order = np.random.default_rng(seed).permutation(len(rows))
    calibrate, fit = order[:n_held], order[n_held:]
    main, bias = Ftrl(len(labels), n_features, rate, beta, l1, l2), Ftrl(len(labels), 1, rate, beta, 0.0, l2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(fit):
            at, x = rows[i]
            w, b = main.weights(at), bias.weights()
            error = softmax(w @ x + b[:, 0])
            error[y[i]] -= 1.0
            main.update(at, error[:, None] * x[None, :], w)
            bias.update(slice(None), error[:, None], b)
    model = Softmax(labels, main.weights(), bias.weights()[:, 0])
    if n_held:
        model.temperature = best_temperature(np.array([model.logits(rows[i]) for i in calibrate]), np.array([y[i] for i in calibrate]))
    return model


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
