"""Follow-the-regularised-leader for sparse multinomial logistic regression, and calibration.

Runs inside one task over a bounded sample: state is one number pair per feature and
class, updates touch the features of the row at hand only.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Example(NamedTuple):
    index: np.ndarray  # distinct features
    value: np.ndarray
    label: int


class Penalty(NamedTuple):
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def fit(rows: list[Example], features: int, classes: int, penalty: Penalty, passes: int, bias: int) -> np.ndarray:
    """Weights (features, classes). Feature ``bias`` is free of the L1 penalty."""

    alpha, beta, l1, l2 = penalty
    z = np.zeros((features, classes))
    n = np.zeros((features, classes))

    def weights(zi: np.ndarray, ni: np.ndarray, free: np.ndarray) -> np.ndarray:
        limit = np.where(free, 0.0, l1)
        inner = np.sign(zi) * np.maximum(np.abs(zi) - limit, 0.0)
        return -inner / ((beta + np.sqrt(ni)) / alpha + l2)

    for _ in range(passes):
        for row in rows:
            zi, ni = z[row.index], n[row.index]
            w = weights(zi, ni, (row.index == bias)[:, None])
            p = softmax(row.value @ w)
            p[row.label] -= 1.0
            g = row.value[:, None] * p
            grown = ni + g * g
            z[row.index] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[row.index] = grown
    return weights(z, n, (np.arange(features) == bias)[:, None])


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on rows that were not fitted."""

    if not len(labels):
        return 1.0

    # Targets a little inside 0 and 1, as if one more row of each class had been seen:
    # a sample without errors then doesn't ask for endless certainty.
    classes = logits.shape[1]
    target = np.full(logits.shape, 1.0 / (len(labels) + classes))
    target[np.arange(len(labels)), labels] = (len(labels) + 1.0) / (len(labels) + classes)

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-300))).sum())

    low, high, golden = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))
