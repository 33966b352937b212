"""Bayesian ridge regression (the chained imputer's regressor, IMP6 / IMP7).

One aggregate gives rows, means and the covariances of features and target; all evidence rounds work on
that features x features matrix in closed form and touch no rows.

Edge cases: rows with a null target are not fitted on; a constant feature gets weight 0; a constant target is
predicted as itself; an empty training set is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the usual flat Gamma priors of noise and weights, and the stopping rule
SHAPE, RATE, ROUNDS, TOLERANCE = 1e-6, 1e-6, 300, 1e-3


@dataclass(frozen=True)
class BayesRidge:
    features: list[str]
    weights: np.ndarray
    intercept: float
    noise: float         # precision of the target's noise
    shrinkage: float     # precision of the weights

    def predict(self) -> Column:
        return sum((F.col(f).cast("double") * float(w) for f, w in zip(self.features, self.weights, strict=True)),
                   F.lit(float(self.intercept)))


def fit_bayes_ridge(df: DataFrame, features: list[str], target: str, where: Column | None = None) -> BayesRidge:
    known = F.col(target).isNotNull() if where is None else F.col(target).isNotNull() & where
    z = [F.col(c).cast("double") for c in (*features, target)]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    r = df.where(known).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(v) for v in z]).alias("mean"),
                            F.array(*[F.covar_pop(z[i], z[j]) for i, j in pairs]).alias("cov")).first()
    if not r["n"]:
        raise ValueError(f"no row to fit {target} on")
    gram = np.zeros((len(z), len(z)))
    for (i, j), v in zip(pairs, r["cov"], strict=True):
        gram[i, j] = gram[j, i] = v * r["n"]
    weights, noise, shrinkage = evidence(gram[:-1, :-1], gram[:-1, -1], gram[-1, -1], r["n"])
    mean = np.array(r["mean"])
    return BayesRidge(list(features), weights, float(mean[-1] - weights @ mean[:-1]), noise, shrinkage)


def evidence(xx: np.ndarray, xy: np.ndarray, yy: float, n: int) -> tuple[np.ndarray, float, float]:
    """Weights and the two precisions that maximise the evidence, from centred sums of products."""
    size, axes = np.linalg.eigh(xx)
    size, along = np.maximum(size, 0), axes.T @ xy
    noise, shrinkage = 1 / (yy / n + np.finfo(float).eps), 1.0
    before = None
    for _ in range(ROUNDS):
        weights = axes @ (along / (size + shrinkage / noise))
        if before is not None and np.abs(weights - before).sum() < TOLERANCE:
            break
        before = weights
        error = max(yy - 2 * weights @ xy + weights @ xx @ weights, 0.0)
        used = (noise * size / (shrinkage + noise * size)).sum()
        shrinkage = (used + 2 * SHAPE) / (weights @ weights + 2 * RATE)
        noise = (n - used + 2 * SHAPE) / (error + 2 * RATE)
    return axes @ (along / (size + shrinkage / noise)), float(noise), float(shrinkage)
