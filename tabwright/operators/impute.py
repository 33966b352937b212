"""Imputation (IMP1-IMP8).

Simple fills are a fitted value per column (``fit_fill``) applied with ``coalesce``.  ``fit_on``
selects the rows the statistics are learnt from: the reference fits on the union of labelled and
scoring rows (``None`` here); passing ``F.col("is_test") == 0`` fits on labelled rows only.

Model-based fills (chained regression, forest regression) train a Spark ML model on the rows
where the target is present and fill the others with its prediction.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.codes import clip
from tabwright.operators import stats
from tabwright.operators.bayes_ridge import fit_bayes_ridge
from tabwright.session import materialize


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """IMP1 / UPD3: null -> constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


@dataclass(frozen=True)
class FillModel:
    values: dict = field(default_factory=dict)

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


def fit_fill(df: DataFrame, spec: dict, fit_on: Column | None = None) -> FillModel:
    """``spec`` maps column -> "mode" | "median" | "mean" | (statistic, row condition).
    All statistics are fitted together in at most three passes (:func:`stats.fit_many`)."""
    many = {}
    for c, how in spec.items():
        where = fit_on
        if isinstance(how, tuple):  # ("median", condition): statistic of a sub-population
            how, cond = how
            where = cond if where is None else (where & cond)
        if how not in ("mode", "median", "mean"):
            raise ValueError(f"unknown fill statistic {how!r}")
        many[c] = (how, c, where)
    return FillModel(stats.fit_many(df, many))


# --- chained-equation (iterative regression) imputation ------------------------------------

def _assemble(df: DataFrame, features: list[str], out: str = "__features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def impute_chained(df: DataFrame, targets: list[str], features: list[str], max_iter: int = 20,
                   lo: float | None = None, hi: float | None = None, fit_on: Column | None = None,
                   tol: float = 1e-3, checkpoint: bool = True, bayesian: bool = False) -> DataFrame:
    """IMP6/IMP7: start every incomplete column at its mean, then for ``max_iter`` rounds refit
    each incomplete column on the rows where it was observed (other columns at their current
    values) and refill the missing rows, clipped to [lo, hi].  Stops early when no fill moves by
    more than ``tol`` times the column's largest absolute value.  With a single incomplete column
    the first round is already the fixed point.  Null features are an error: fill them first.
    The regression is least squares, or Bayesian ridge (``bayesian``).

    Each round cuts the lineage with a reliable ``checkpoint()`` (to ``spark.checkpoint.dir``)."""
    miss = {t: f"__miss_{t}" for t in targets}
    last = {t: f"__last_{t}" for t in targets}
    means = {t: stats.mean_value(df, t, fit_on) for t in targets}
    cur = df.withColumns({m: F.col(t).isNull() for t, m in miss.items()})
    cur = cur.withColumns({t: F.coalesce(F.col(t).cast("double"), F.lit(means[t])) for t in targets})
    for _ in range(max_iter):
        cur = cur.withColumns({p: F.col(t) for t, p in last.items()})
        for t in targets:
            inputs = [c for c in features + targets if c != t]
            if bayesian:
                observed = ~F.col(miss[t]) if fit_on is None else ~F.col(miss[t]) & fit_on
                guess = fit_bayes_ridge(cur, inputs, t, observed).predict()
                cur = cur.withColumn(t, F.when(F.col(miss[t]), clip(guess, lo, hi)).otherwise(F.col(t)))
                continue
            assembled = _assemble(cur, inputs)
            train = assembled.filter(~F.col(miss[t]))
            if fit_on is not None:
                train = train.filter(fit_on)
            model = LinearRegression(featuresCol="__features", labelCol=t, predictionCol="__pred",
                                     solver="normal", regParam=0.0).fit(train)
            cur = (model.transform(assembled)
                   .withColumn(t, F.when(F.col(miss[t]), clip(F.col("__pred"), lo, hi)).otherwise(F.col(t)))
                   .drop("__features", "__pred"))
        if checkpoint:
            cur = materialize(cur)
        if len(targets) == 1:
            break  # the other inputs never change, so a refit returns the same fill
        moved = cur.agg(*[F.max(F.abs(F.col(t) - F.col(last[t]))).alias(t) for t in targets],
                        *[F.max(F.abs(F.col(t))).alias(f"{t}__size") for t in targets]).first()
        if all((moved[t] or 0.0) <= tol * (moved[f"{t}__size"] or 0.0) for t in targets):
            break
    return cur.drop(*miss.values(), *last.values())


def reimpute_out_of_range(df: DataFrame, target: str, features: list[str], lo: float, hi: float,
                          **kw) -> DataFrame:
    """UPD4: values outside [lo, hi] become missing and are filled again by chained regression."""
    bad = (F.col(target) < lo) | (F.col(target) > hi)
    cleared = df.withColumn(target, F.when(bad, F.lit(None)).otherwise(F.col(target)))
    return impute_chained(cleared, [target], features, lo=lo, hi=hi, **kw)


def impute_forest(df: DataFrame, target: str, features: list[str], num_trees: int = 100, seed: int = 0,
                  max_depth: int = 10, fit_on: Column | None = None, max_memory_mb: int = 1024) -> DataFrame:
    """IMP8: random-forest regression of ``target`` on ``features`` over rows where it is known;
    missing values take the forest's prediction.  String features are one-hot encoded first
    (ENC2) with a fitted value list."""
    from tabwright.operators.encode import fit_one_hot, string_columns
    strings = [c for c in string_columns(df.select(*features))]
    if strings:
        oh = fit_one_hot(df, strings)
        df = oh.apply(df, keep_source=True)
        features = [c for c in features if c not in strings] + oh.dummy_names()
    assembled = _assemble(df, features)
    train = assembled.filter(F.col(target).isNotNull())
    if fit_on is not None:
        train = train.filter(fit_on)
    model = RandomForestRegressor(featuresCol="__features", labelCol=target, predictionCol="__pred",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                  maxMemoryInMB=max_memory_mb).fit(train)
    out = (model.transform(assembled)
           .withColumn(target, F.coalesce(F.col(target), F.col("__pred")))
           .drop("__features", "__pred"))
    return out.drop(*oh.dummy_names()) if strings else out
