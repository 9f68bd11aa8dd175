"""Linear models from moments, with the penalties of Spark's linear regression."""

from __future__ import annotations

import numpy as np

from loadgrain.functions.moments import Moments

LINEAR = ("regParam", "elasticNetParam", "fitIntercept", "standardization")
TOLERANCE = 1e-12
MAX_ROUNDS = 100_000


def solve_linear(
    train: Moments,
    regParam: float = 0.0,
    elasticNetParam: float = 0.0,
    fitIntercept: bool = True,
    standardization: bool = True,
) -> tuple[np.ndarray, float]:
    """Weights and constant; the last column of ``train`` is the target.

    The squared error per row, halved, plus ``regParam`` times a mix of the sum of absolute weights (``elasticNetParam``) and half
    the sum of their squares. Features and target are scaled to a deviation of one before, and with ``standardization``
    the penalty falls on the scaled weights. A feature that doesn't vary gets no weight.
    """
    p = len(train.mean) - 1
    spread = train.spread / train.n
    deviation = np.sqrt(np.diag(spread))
    scale, of_target = deviation[:p], deviation[p]
    use = scale > 0
    mean = train.mean
    if of_target == 0:
        if fitIntercept or mean[p] == 0:
            return np.zeros(p), float(mean[p]) if fitIntercept else 0.0
        of_target = abs(mean[p])
    moment = spread if fitIntercept else spread + np.outer(mean, mean)
    a = moment[:p, :p][np.ix_(use, use)] / np.outer(scale[use], scale[use])
    b = moment[:p, p][use] / (scale[use] * of_target)
    penalty = np.full(len(b), regParam / of_target)
    ridge, lasso = penalty * (1 - elasticNetParam), penalty * elasticNetParam
    if not standardization:
        ridge, lasso = ridge / scale[use] ** 2, lasso / scale[use]
    w = _descended(a + np.diag(ridge), b, lasso) if lasso.any() else np.linalg.lstsq(a + np.diag(ridge), b, rcond=None)[0]
    weights = np.zeros(p)
    weights[use] = w * of_target / scale[use]
    return weights, float(mean[p] - weights @ mean[:p]) if fitIntercept else 0.0


def _descended(a: np.ndarray, b: np.ndarray, lasso: np.ndarray) -> np.ndarray:
    """The least of half a quadratic form with absolute penalties, one weight after the other."""
    w = np.zeros(len(b))
    for _ in range(MAX_ROUNDS):
        largest = 0.0
        for i in range(len(b)):
            rest = b[i] - a[i] @ w + a[i, i] * w[i]
            new = np.sign(rest) * max(abs(rest) - lasso[i], 0.0) / a[i, i]
            largest = max(largest, abs(new - w[i]))
            w[i] = new
        if largest < TOLERANCE:
            break
    return w
