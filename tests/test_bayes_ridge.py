"""Bayesian ridge against an evidence iteration over the raw rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators.bayes_ridge import fit_bayes_ridge
from tabwright.operators.impute import impute_chained


def over_rows(x, y):
    mx, my = x.mean(axis=0), y.mean()
    x, y = x - mx, y - my
    a, lam, old = 1 / (y.var() + np.finfo(float).eps), 1.0, None
    solve = lambda: np.linalg.solve(x.T @ x + lam / a * np.eye(x.shape[1]), x.T @ y)
    for _ in range(300):
        w = solve()
        if old is not None and np.abs(w - old).sum() < 1e-3:
            break
        old = w
        s = np.linalg.svd(x, compute_uv=False) ** 2
        g = (a * s / (lam + a * s)).sum()
        lam = (g + 2e-6) / (w @ w + 2e-6)
        a = (len(y) - g + 2e-6) / (((y - x @ w) ** 2).sum() + 2e-6)
    return solve(), my - solve() @ mx, a, lam


@pytest.mark.parametrize("noise", [0.1, 5.0])
def test_equals_the_iteration_over_rows(spark, noise):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3)) * [1, 10, 0.1] + [5, -3, 100]
    y = x @ [2.0, -0.5, 0.0] + 7 + noise * rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y, strict=True)],
                               "a double, b double, c double, y double").repartition(5)
    m = fit_bayes_ridge(df.unionByName(df.withColumn("y", F.lit(None).cast("double"))), ["a", "b", "c"], "y")
    w, intercept, a, lam = over_rows(x, y)
    np.testing.assert_allclose(m.weights, w, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose([m.intercept, m.noise, m.shrinkage], [intercept, a, lam], rtol=1e-7)
    got = df.select((m.predict() - (F.col("a") * float(w[0]) + F.col("b") * float(w[1]) + F.col("c") * float(w[2]) + float(intercept)))
                    .alias("d")).agg(F.max(F.abs("d"))).first()[0]
    assert got < 1e-9


def test_chained_fill_by_bayesian_ridge(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(1, 4, 200).astype(float)
    age = [None if i % 5 == 0 else float(30 + 4 * v + e) for i, (v, e) in enumerate(zip(x, rng.normal(size=200), strict=True))]
    df = spark.createDataFrame([(i, float(v), a, 1.0) for i, (v, a) in enumerate(zip(x, age, strict=True))],
                               "id long, x double, age double, same double")
    got = {r["id"]: r["age"] for r in impute_chained(df, ["age"], ["x", "same"], lo=0.0, hi=41.0, bayesian=True).collect()}
    known = np.array([a is not None for a in age])
    w, b, _, _ = over_rows(np.stack([x[known], np.ones(known.sum())], axis=1), np.array([a for a in age if a is not None]))
    for i, a in enumerate(age):
        assert got[i] == pytest.approx(a if a is not None else min(x[i] * w[0] + w[1] + b, 41.0), abs=1e-9)
    with pytest.raises(ValueError, match="no row"):
        fit_bayes_ridge(df.where("id < 0"), ["x"], "age")
