"""Model layer (MOD*, PIP1, ENS1, GRD1, CV1, LDB*, EVL6-EVL8, DRF1-DRF2) on Spark ML.

Every model is a ``Pipeline`` (assembler -> optional ANOVA selector -> estimator) fitted on
executors; scored frames keep their key column, so predictions are never glued by position.
Model outputs are small tables (one row per model, round, fold or feature) built from the
fitted models, never from collected data.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import product
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, FMClassifier, LinearSVC, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.operators import boosting, ensembles, metrics
from tabwright.operators import perceptron as nets
from tabwright.operators.boosting import Boost, Forest
from tabwright.operators.discriminant import KINDS, Discriminant, Moments, class_moments, solve
from tabwright.operators.ensembles import AdaBoost, ExtraTrees
from tabwright.operators.neighbours import NearestNeighbours
from tabwright.operators.perceptron import Perceptron
from tabwright.operators.select import select_k_best
from tabwright.operators.split import holdout_flag, kfold
from tabwright.session import materialize

FEATURES = "features"
ROWS_GATHERED = 100_000
LEAST_GATHERED = 4


def ml_names(df: DataFrame) -> DataFrame:
    """Spark ML cannot take input columns whose names hold dots (``family_survival_0.5``); rename
    them once (dot -> underscore) before fitting."""
    return df.select(*[F.col("`" + c + "`").alias(c.replace(".", "_")) for c in df.columns])


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error")


def selector(k: int, n_features: int) -> UnivariateFeatureSelector:
    """ANOVA-F selection of the k best features (all of them when k >= n)."""
    sel = UnivariateFeatureSelector(featuresCol=FEATURES, outputCol="selected", labelCol="label",
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(min(k, n_features))
    return sel


# --- estimators with the reference's settings ---------------------------------------------------

def random_forest(features_col=FEATURES, seed=42, num_trees=26, max_depth=10, keep_nodes=True):
    """MOD1: 26 trees, depth 10, sqrt features per split.  ``keep_nodes``: every row's nodes (a number a tree) are kept from level
    to level instead of walking each tree from its root again; the forest is the same."""
    return RandomForestClassifier(featuresCol=features_col, labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                  featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=keep_nodes)


def gradient_boosting(rounds=100, depth=3, rate=0.1) -> Boost:
    """MOD2: 100 boosting rounds of depth-3 trees, learning rate 0.1; splits weigh children by their rows."""
    return Boost(rounds=rounds, rate=rate, depth=depth, l2=0.0, min_weight=0.0, by_rows=True)


def hist_boosting(rounds=100) -> Boost:
    """MOD3: leaf-wise histogram boosting, 50 leaves, 20 rows a leaf at least."""
    return Boost(rounds=rounds, rate=0.1, depth=None, leaves=50, l2=0.0, min_weight=1e-3, min_rows=20)


def boosting_presets() -> dict:
    """MOD5: the reference's third-party boosters with their defaults (those libraries are absent).  The third one grows
    symmetric trees; its ordered target statistics of categories are ``encode.ordered_target_mean``."""
    return {
        "xgboost_like": Boost(rounds=100, rate=0.3, depth=6, base=0.0),
        "lightgbm_like": Boost(rounds=100, rate=0.1, depth=None, leaves=31, l2=0.0, min_weight=1e-3, min_rows=20),
        "catboost_like": Boost(rounds=100, rate=0.05, depth=6, l2=3.0, symmetric=True),
    }


def logistic(features_col=FEATURES, c: float = 1.0, n_rows: int = 1, max_iter=600):
    """MOD6: L2 logistic regression; the inverse strength C maps to regParam = 1 / (C * n)."""
    return LogisticRegression(featuresCol=features_col, labelCol="label", maxIter=max_iter,
                              regParam=1.0 / (c * max(n_rows, 1)), elasticNetParam=0.0)


def decision_tree(features_col=FEATURES, seed=42, max_depth=5):
    """MOD7."""
    return DecisionTreeClassifier(featuresCol=features_col, labelCol="label", maxDepth=max_depth, seed=seed)


def perceptron(hidden=(64, 128, 64, 32, 8), activation="relu", alpha=1e-4, epochs=200, rate=0.01, seed=42) -> Perceptron:
    """MOD8 / MOD9: feed-forward net with relu, tanh or logistic layers and an L2 penalty."""
    return Perceptron(hidden=tuple(hidden), activation=activation, alpha=alpha, epochs=epochs, rate=rate, seed=seed)


@dataclass
class BoostPipeline:
    """PIP1 for boosted trees: the k best features by ANOVA F (all when fewer), then the trees."""
    features: list[str]
    spec: Boost
    k: int | None = None

    def chosen(self, df: DataFrame) -> list[str]:
        return self.features if self.k is None else select_k_best(df, self.features, "label", self.k)

    def fit(self, df: DataFrame) -> boosting.Model:
        return boosting.fit_all(df, self.chosen(df), [self.spec])[0]


@dataclass
class SpecPipeline:
    """PIP1 for the library's own classifiers: the k best features by ANOVA F (all when fewer), then the model."""
    features: list[str]
    spec: object
    k: int | None = None

    def fit(self, df: DataFrame):
        features = self.features if self.k is None else select_k_best(df, self.features, "label", self.k)
        if isinstance(self.spec, Perceptron):
            return nets.fit_all(df, features, [self.spec])[0][0]
        if isinstance(self.spec, (AdaBoost, ExtraTrees)):
            return ensembles.fit_all(df, features, [self.spec])[0][0]
        return self.spec.fit(df, features)


def pipeline(features: list[str], estimator, k: int | None = None):
    """PIP1: assembler -> (selector) -> estimator."""
    if isinstance(estimator, Boost):
        return BoostPipeline(features, estimator, k)
    if isinstance(estimator, (Discriminant, Perceptron, AdaBoost, ExtraTrees, NearestNeighbours)):
        return SpecPipeline(features, estimator, k)
    stages = [assembler(features)]
    if k is not None:
        stages.append(selector(k, len(features)))
        estimator = estimator.copy()
        estimator.setFeaturesCol("selected")
    return Pipeline(stages=stages + [estimator])


def fit_models(train: DataFrame, features: list[str], estimators: dict, k: int | None = None, parallelism: int = 4) -> dict:
    """Name -> fitted model, or the exception that its fit ended in.  Boosted models share one binned table and
    advance together; the others, and forests, which need single rows, are fitted next to them."""
    boosted = [n for n, e in estimators.items() if isinstance(e, Boost) and not isinstance(e, Forest)]
    together = BoostPipeline(features, Boost(), k)
    jobs = {n: (lambda e=e: pipeline(features, e, k).fit(gathered(train) if isinstance(e, LogisticRegression) else train))
            for n, e in estimators.items() if n not in boosted}
    if boosted:
        jobs[""] = lambda: boosting.fit_all(train, together.chosen(train), [estimators[n] for n in boosted])
    done = fit_parallel(jobs, parallelism)
    got = done.pop("", [])
    for i, n in enumerate(boosted):
        done[n] = got if isinstance(got, Exception) else got[i]
    return {n: done[n] for n in estimators}


# --- scoring helpers -------------------------------------------------------------------------------

def p_one(col: str = "probability"):
    """Probability of class 1 from a probability vector."""
    return vector_to_array(F.col(col)).getItem(1)


def score(model: PipelineModel, df: DataFrame, key: str, threshold: float = 0.5, keep=("label",)) -> DataFrame:
    """(key, [label], score, prediction) with prediction = score > threshold."""
    out = model.transform(df)
    s = p_one() if "probability" in out.columns else F.col("prediction").cast("double")
    cols = [F.col(key)] + [F.col(c) for c in keep if c in df.columns]
    return out.select(*cols, s.alias("score"), (s > F.lit(threshold)).cast("int").alias("prediction"))


def holdout(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flagged = holdout_flag(df, key, fraction, seed, "__hold")
    return flagged.filter("__hold = 0").drop("__hold"), flagged.filter("__hold = 1").drop("__hold")


# --- soft voting (ENS1) -------------------------------------------------------------------------------

@dataclass
class SoftVoter:
    models: dict            # name -> fitted PipelineModel
    weights: dict           # name -> weight; 0 drops the model

    def transform(self, df: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
        active = {n: m for n, m in self.models.items() if self.weights.get(n, 0)}
        total = float(sum(self.weights[n] for n in active))
        base = df
        for n, m in active.items():
            scored = m.transform(base)
            base = scored.withColumn(f"__p_{n}", p_one()).drop(
                *[c for c in scored.columns if c not in base.columns and c != f"__p_{n}"])
        s = sum(F.lit(float(self.weights[n])) * F.col(f"__p_{n}") for n in active) / F.lit(total)
        keep = [c for c in (key, "label") if c in df.columns]
        return base.select(*keep, s.alias("score"), (s > F.lit(threshold)).cast("int").alias("prediction"))


@dataclass
class ColumnModel:
    """A member whose probability of label 1 is a column already (scores made elsewhere)."""
    column: str

    def transform(self, df: DataFrame) -> DataFrame:
        p = F.col(self.column).cast("double")
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def results_table(scored: dict) -> DataFrame:
    """EVL6 + AGG14: accuracy, f1 and hard AUC of every scored frame (``label, prediction``), and the gain in
    accuracy over the worst."""
    rows = None
    for name, s in scored.items():
        m = metrics.binary_metrics(s, "label", "prediction").select(
            F.lit(name).alias("model"), "accuracy", "f1", "auc_hard")
        rows = m if rows is None else rows.unionByName(m)
    worst = F.min("accuracy").over(Window.partitionBy(F.lit(1)))  # one row per model
    return rows.withColumn("gain_over_worst", F.col("accuracy") - worst)


def fit_parallel(jobs: dict, parallelism: int = 4) -> dict:
    """Run independent fits (name -> zero-argument callable) from a small thread pool; Spark runs
    their jobs concurrently, as ``CrossValidator(parallelism=...)`` does.  Exceptions are returned
    in place of results."""
    def run(fn):
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 — handed back to the caller
            return e
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {n: pool.submit(run, fn) for n, fn in jobs.items()}
        return {n: f.result() for n, f in futures.items()}


def fit_soft_voter(train: DataFrame, features: list[str], estimators: dict, weights: dict | None = None,
                   k: int | None = None, parallelism: int = 4) -> SoftVoter:
    weights = weights or {n: 1.0 for n in estimators}
    fitted = fit_models(train, features, {n: e for n, e in estimators.items() if weights.get(n, 0)}, k, parallelism)
    for n, m in fitted.items():
        if isinstance(m, Exception):
            raise m
    return SoftVoter(fitted, weights)


# --- boosted regression with patience (MOD4, EVL7, Q13) -------------------------------------------------

@dataclass
class PatienceBoost:
    model: boosting.Model
    rounds: DataFrame        # (round, set, rmse) — the per-round loss table
    stop_round: int | None   # first round whose patience counter reached the limit
    best_round: int


def boost_with_patience(train: DataFrame, valid: DataFrame, features: list[str], max_rounds: int = 50_000,
                        patience: int = 15, step: float = 0.1, depth: int = 6, use: str = "last") -> PatienceBoost:
    """Boosted regression trees with a patience stop on the validation error (an equal error does not
    reset the counter).  Margins are carried on training and validation rows, so every round's errors
    come with the next round's first job and nothing is fitted twice.  The kept model has the rounds up to
    the stop ("last") or up to the best round ("best"); the loss table holds the rounds up to the stop."""
    cols = [*features, "label"]
    both = (train.select(*cols, F.lit(0).alias("__set")).unionByName(valid.select(*cols, F.lit(1).alias("__set"))))
    spec = Boost(rounds=max_rounds, rate=step, depth=depth, loss="squared", base=0.5, held=1, patience=patience)
    m = boosting.fit_all(both, features, [spec], fold="__set")[0]
    curve = m.curve[1:]
    best = min(range(len(curve)), key=lambda i: (curve[i]["held_loss"], i))
    rows = [(i, name, (c[f"{part}_loss"] / c[f"{part}_n"]) ** 0.5) for name, part in (("train", "train"), ("eval", "held"))
            for i, c in enumerate(curve)]
    rounds = train.sparkSession.createDataFrame(rows, "round int, set string, rmse double")
    return PatienceBoost(m.prefix(best + 1) if use == "best" else m, rounds, m.stop_round, best)


# --- cross-validation, grid search, leaderboards ---------------------------------------------------------

def cross_val_accuracy(df: DataFrame, features: list[str], estimator, fold_col: str = "fold", k: int = 3,
                       threshold: float = 0.5, parallelism: int = 5, fit=None) -> DataFrame:
    """CV1: (fold, accuracy) — fit on the other folds, score this one; folds run side by side.  ``estimator`` is one
    estimator, or a dict of them that vote softly with equal weights.  ``fit`` gives the model of a fold (None: the estimator's)."""
    voters = [None] * k
    if isinstance(estimator, dict):
        voters = [SoftVoter(m, dict.fromkeys(m, 1.0)) for m in fold_models(df, features, estimator, fold_col, k, parallelism)]

    def held(i: int) -> float:
        rest, fold = df.filter(F.col(fold_col) != i), df.filter(F.col(fold_col) == i)
        scored = (voters[i].transform(fold, fold_col, threshold) if voters[i]
                  else score(fit(i) if fit else pipeline(features, estimator).fit(rest), fold, fold_col, threshold))
        return float(scored.agg(metrics.accuracy_expr("label", "prediction")).first()[0])

    done = fit_parallel({i: (lambda i=i: held(i)) for i in range(k)}, parallelism)
    for x in done.values():
        if isinstance(x, Exception):
            raise x
    rows = sorted(done.items())
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def fold_models(df: DataFrame, features: list[str], estimators: dict, fold_col: str, k: int, parallelism: int) -> list[dict]:
    """Per fold the models (by name) fitted on the other folds.  All folds' boosted models, forests and nets are one fit each, so
    their bins and scales are those of the whole table (features only)."""
    bagged = [n for n, e in estimators.items() if isinstance(e, Forest)]
    boosted = [n for n, e in estimators.items() if isinstance(e, Boost) and n not in bagged]
    netted = [n for n, e in estimators.items() if isinstance(e, Perceptron)]
    held = lambda names: [replace(estimators[n], held=f) for n in names for f in range(k)]
    few = gathered(df)
    jobs = {(n, f): (lambda e=e, f=f: pipeline(features, e).fit(
                (few if isinstance(e, LogisticRegression) else df).filter(F.col(fold_col) != f)))
            for n, e in estimators.items() if n not in (*boosted, *bagged, *netted) for f in range(k)}
    if bagged:
        jobs["bagged"] = lambda: boosting.fit_all(df, features, held(bagged), fold=fold_col)
    if boosted:
        jobs["boosted"] = lambda: boosting.fit_all(df, features, held(boosted), fold=fold_col)
    if netted:
        jobs["netted"] = lambda: nets.fit_all(df, features, held(netted), fold=fold_col)[0]
    done = fit_parallel(jobs, parallelism)
    for x in done.values():
        if isinstance(x, Exception):
            raise x
    for job, names in (("boosted", boosted), ("bagged", bagged), ("netted", netted)):
        for i, m in enumerate(done.get(job, [])):
            done[names[i // k], i % k] = m
    return [{n: done[n, f] for n in estimators} for f in range(k)]


def grid_points(estimator, grid: dict) -> list[dict]:
    """Every combination of the grid's values as a param map of the estimator."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def point_name(point: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))


def grid_scores(df: DataFrame, features: list[str], estimator, points: list[dict], fold_col: str = "fold",
                k: int = 3, parallelism: int = 4) -> list[float]:
    """Mean accuracy over the k folds of ``fold_col`` for every point; a fold's points are fitted
    concurrently."""
    if not points:
        return []
    data = gathered(materialize(assembler(features).transform(df).select(FEATURES, "label", fold_col)))
    accuracy = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    sums = [0.0] * len(points)
    for i in range(k):
        rest, fold = data.filter(F.col(fold_col) != i).persist(), data.filter(F.col(fold_col) == i).persist()
        got = fit_parallel({j: (lambda point=point: accuracy.evaluate(estimator.copy(point).fit(rest).transform(fold)))
                            for j, point in enumerate(points)}, parallelism)
        rest.unpersist()
        fold.unpersist()
        for j, acc in got.items():
            if isinstance(acc, Exception):
                raise acc
            sums[j] += float(acc)
    return [x / k for x in sums]


def grid_search(df: DataFrame, features: list[str], estimator, grid: dict, fold_col: str = "fold",
                k: int = 3, parallelism: int = 4, seen: dict | None = None):
    """GRD1: cross-validated accuracy of every grid point, and the estimator set to the best one (for
    the caller to fit on all rows).  Returns (rows of (params, mean_accuracy, rank), best estimator).
    ``seen`` keeps the scores by point: searches of the same kind of estimator over the same folds
    that share it fit a point once."""
    points, seen = grid_points(estimator, grid), {} if seen is None else seen
    todo = [x for x in points if point_name(x) not in seen]
    seen.update(zip(map(point_name, todo), grid_scores(df, features, estimator, todo, fold_col, k, parallelism)))
    best_first = sorted(points, key=lambda x: (-seen[point_name(x)], point_name(x)))
    rows = [(point_name(x), seen[point_name(x)], i) for i, x in enumerate(best_first, 1)]
    return rows, estimator.copy(best_first[0])


def boost_points(grid: dict) -> list[dict]:
    """Every combination of a boosted family's grid (``rounds``, ``rate`` and ``depth`` or ``leaves``)."""
    size = "leaves" if "leaves" in grid else "depth"
    return [{"rounds": n, "rate": r, size: d} for n in grid["rounds"] for r in grid["rate"] for d in grid[size]]


def boost_grids(df: DataFrame, features: list[str], families: dict, fold_col: str = "fold", k: int = 5) -> dict:
    """GRD1 for boosted families (name -> (settings, grid)): name -> (rows of (params, mean_accuracy, rank), best settings).

    One fit of the largest number of rounds per (family, rate, size, fold), all over one binned table; the
    smaller numbers of rounds are read off its curve, since the first rounds of a fit are the shorter fit."""
    fits = {}
    for name, (spec, grid) in families.items():
        for p in boost_points(grid):
            settings = replace(spec, **(p | {"rounds": max(grid["rounds"])}))
            for f in range(k):
                fits.setdefault(replace(settings, held=f), None)
    models = dict(zip(fits, boosting.fit_all(df, features, list(fits), fold=fold_col, curves_only=True), strict=True))
    out = {}
    for name, (spec, grid) in families.items():
        scores = []
        for p in boost_points(grid):
            settings = replace(spec, **(p | {"rounds": max(grid["rounds"])}))
            ends = [models[replace(settings, held=f)].curve[p["rounds"]] for f in range(k)]
            params = ", ".join(f"{a}={b}" for a, b in sorted(p.items()))
            scores.append((params, sum(e["held_hits"] / e["held_n"] for e in ends) / k, replace(spec, **p)))
        scores.sort(key=lambda x: (-x[1], x[0]))
        out[name] = [(params, acc, i) for i, (params, acc, _) in enumerate(scores, 1)], scores[0][2]
    return out


def forest_grid(df: DataFrame, features: list[str], spec: Forest, grid: dict, fold_col: str = "fold", k: int = 5,
                key: str | None = None):
    """GRD1 for forests: (rows of (params, mean_accuracy, rank), best settings).  One forest per (fold, other settings) of the
    most trees and the greatest depth: fewer trees are its first ones, and a smaller depth cuts its trees, since what a node
    draws depends on the seed, the tree and the node alone."""
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    depths = sorted({p.get("depth", spec.depth) for p in points}, key=lambda d: float("inf") if d is None else d, reverse=True)
    base = replace(spec, rounds=max(p.get("rounds", spec.rounds) for p in points), depth=depths[0], depths=tuple(depths[1:]))

    def grown(p: dict) -> Forest:
        return replace(base, **{a: v for a, v in p.items() if a not in ("rounds", "depth")})

    fits = list(dict.fromkeys(replace(grown(p), held=f) for p in points for f in range(k)))
    models = dict(zip(fits, boosting.fit_all(df, features, fits, fold=fold_col, key=key, curves_only=True), strict=True))
    scores = []
    for p in points:
        at, j, share = p.get("rounds", spec.rounds), depths.index(p.get("depth", spec.depth)), 0.0
        for m in (models[replace(grown(p), held=f)] for f in range(k)):
            hits = m.cut_hits[at][j - 1] if j else m.curve[at]["held_hits"]
            share += hits / m.curve[at]["held_n"]
        scores.append((", ".join(f"{a}={b}" for a, b in sorted(p.items())), share / k, replace(spec, **p)))
    scores.sort(key=lambda x: (-x[1], x[0]))
    return [(params, acc, i) for i, (params, acc, _) in enumerate(scores, 1)], scores[0][2]


def net_grid(df: DataFrame, features: list[str], spec: Perceptron, grid: dict, fold_col: str = "fold", k: int = 5):
    """GRD1 for perceptrons: (rows of (params, mean_accuracy, rank), best settings).  All points and folds are
    one fit over one table, a step of every net at a time; features are scaled by all rows of the table, as the
    reference scales before its search."""
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    _, told = nets.fit_all(df, features, [replace(spec, held=f, **p) for p in points for f in range(k)], fold=fold_col)
    scores = []
    for i, p in enumerate(points):
        ends = [curve[-1] for curve in told[i * k:(i + 1) * k]]
        params = ", ".join(f"{a}={b}" for a, b in sorted(p.items()))
        scores.append((params, sum(e["held_hits"] / e["held_n"] for e in ends) / k, replace(spec, **p)))
    scores.sort(key=lambda x: (-x[1], x[0]))
    return [(params, acc, i) for i, (params, acc, _) in enumerate(scores, 1)], scores[0][2]


def tuning_grids(n_rows: int) -> dict:
    """The reference's seven model families: name -> (kind, estimator, grid)."""
    boosted = {"rounds": [50, 100, 200], "rate": [0.01, 0.1, 0.2]}
    presets = boosting_presets()
    return {
        "random_forest": ("forest", Forest(), {"rounds": [50, 100, 200], "depth": [None, 10, 20, 30]}),
        "logistic_regression": ("logistic", logistic(n_rows=n_rows),
                                {"regParam": [1.0 / (c * max(n_rows, 1)) for c in (0.1, 1.0, 10.0)]}),
        "perceptron": ("net", perceptron(epochs=1000),
                       {"hidden": [(50, 50), (100,)], "activation": ["relu", "tanh"], "alpha": [0.0001, 0.001]}),
        "gradient_boosting": ("boost", gradient_boosting(), boosted | {"depth": [3, 5, 7]}),
        "xgboost_like": ("boost", presets["xgboost_like"], boosted | {"depth": [3, 5, 7]}),
        "lightgbm_like": ("boost", presets["lightgbm_like"], boosted | {"leaves": [31, 50, 100]}),
        "catboost_like": ("boost", presets["catboost_like"], boosted | {"depth": [3, 5, 7]}),
    }


def tune(df: DataFrame, features: list[str], grids: dict, fold_col: str = "fold", k: int = 5,
         key: str | None = None) -> tuple[list, dict]:
    """Rows (model, folds, params, mean_accuracy, rank) of every family's grid, and its best estimator.  Forests draw their
    rows by ``key``."""
    families = {n: (est, grid) for n, (kind, est, grid) in grids.items() if kind == "boost"}
    jobs = {n: (lambda est=est, grid=grid: grid_search(df, features, est, grid, fold_col, k))
            for n, (kind, est, grid) in grids.items() if kind not in ("boost", "net", "forest")}
    jobs |= {n: (lambda est=est, grid=grid: net_grid(df, features, est, grid, fold_col, k))
             for n, (kind, est, grid) in grids.items() if kind == "net"}
    jobs |= {n: (lambda est=est, grid=grid: forest_grid(df, features, est, grid, fold_col, k, key))
             for n, (kind, est, grid) in grids.items() if kind == "forest"}
    if families:
        jobs[""] = lambda: boost_grids(df, features, families, fold_col, k)
    done = fit_parallel(jobs, len(jobs))
    for x in done.values():
        if isinstance(x, Exception):
            raise x
    done |= done.pop("", {})
    rows = [(name, k, *x) for name in grids for x in done[name][0]]
    return rows, {name: done[name][1] for name in grids}


def leaderboard(train: DataFrame, test: DataFrame, features: list[str], estimators: dict, key: str,
                threshold: float = 0.5, parallelism: int = 4) -> DataFrame:
    """LDB1/LDB2/EVL6: hold-out accuracy, f1 and hard AUC per model, best first.  Models are
    fitted concurrently (``parallelism``).  A model that fails to fit is kept as a row with its
    error instead of being skipped silently."""
    spark = train.sparkSession

    def evaluate(model):
        if isinstance(model, Exception):
            raise model
        return metrics.binary_metrics(score(model, test, key, threshold), "label", "prediction").first()

    fitted = fit_models(train, features, estimators, parallelism=parallelism)
    results = fit_parallel({n: (lambda m=m: evaluate(m)) for n, m in fitted.items()}, parallelism)
    rows = []
    for name, m in results.items():
        if isinstance(m, Exception):
            rows.append((name, None, None, None, str(m).splitlines()[0][:200]))
        else:
            rows.append((name, float(m["accuracy"]), float(m["f1"]), float(m["auc_hard"]), None))
    board = spark.createDataFrame(rows, "model string, accuracy double, f1 double, auc_hard double, error string")
    return board.orderBy(F.desc_nulls_last("accuracy"), "model")


def gathered(df: DataFrame) -> DataFrame:
    """The rows in few partitions (ROWS_GATHERED rows each, at least LEAST_GATHERED where there are as many), for Spark's own
    estimators: they run a job a step or tree level, in which every partition costs a task and sends a sum for every open node."""
    now, n = df.rdd.getNumPartitions(), df.count()
    parts = max(min(now, LEAST_GATHERED), -(-n // ROWS_GATHERED))
    return df.coalesce(parts) if parts < now else df


def cv_leaderboard(df: DataFrame, features: list[str], estimators: dict, key: str, k: int = 3, seed: int = 1,
                   parallelism: int = 4) -> DataFrame:
    """LDB2: mean k-fold accuracy of every estimator, best first; one that fails to fit keeps its error."""
    folds = materialize(kfold(df, key, k, seed))
    few = gathered(folds)
    known, locks = {}, [Lock() for _ in range(k)]

    def moments(f: int) -> Moments:
        """Of the rows outside a fold, gathered once for all kinds of discriminants."""
        with locks[f]:
            if f not in known:
                known[f] = class_moments(folds.filter(F.col("fold") != f), features, "label")
            return known[f]

    def evaluate(est):
        if isinstance(est, Boost):  # the folds advance together
            models = boosting.fit_all(folds, features, [replace(est, held=f) for f in range(k)], fold="fold", curves_only=True)
            return sum(m.curve[-1]["held_hits"] / m.curve[-1]["held_n"] for m in models) / k
        if isinstance(est, Perceptron):
            _, told = nets.fit_all(folds, features, [replace(est, held=f) for f in range(k)], fold="fold")
            return sum(c[-1]["held_hits"] / c[-1]["held_n"] for c in told) / k
        if isinstance(est, (AdaBoost, ExtraTrees)):
            _, told = ensembles.fit_all(folds, features, [replace(est, held=f) for f in range(k)], fold="fold")
            return sum(hits / n for n, hits in told) / k
        own = isinstance(est, (Discriminant, NearestNeighbours))
        fit = (lambda f: solve(est.kind, moments(f), features)) if isinstance(est, Discriminant) else None
        return cross_val_accuracy(folds if own else few, features, est, "fold", k, fit=fit).agg(F.avg("accuracy")).first()[0]

    results = fit_parallel({n: (lambda est=est: evaluate(est)) for n, est in estimators.items()}, parallelism)
    rows = [(n, None, str(m).splitlines()[0][:200]) if isinstance(m, Exception) else (n, float(m), None)
            for n, m in results.items()]
    board = df.sparkSession.createDataFrame(rows, "model string, mean_accuracy double, error string")
    return board.orderBy(F.desc_nulls_last("mean_accuracy"), "model")


def all_classifiers(n_rows: int, seed: int = 42) -> dict:
    """Every classifier there is, with the defaults of the reference's library (the 'all available
    estimators' sweep): 100 trees or rounds, 50 stumps, 5 neighbours, one hidden layer of 100; unlimited
    depth is Spark's 30, for the randomised trees 10."""
    return {
        "logistic_regression": logistic(c=1.0, n_rows=n_rows, max_iter=100),
        "decision_tree": decision_tree(seed=seed, max_depth=30),
        "random_forest": random_forest(seed=seed, num_trees=100, max_depth=30),
        "gbt": gradient_boosting(),
        "hist_boosting": hist_boosting(),
        "perceptron": perceptron(hidden=(100,), seed=seed),
        **{kind: Discriminant(kind) for kind in KINDS},
        "adaboost": AdaBoost(),
        "extra_trees": ExtraTrees(seed=seed),
        "nearest_neighbours": NearestNeighbours(),
        "linear_svc": LinearSVC(featuresCol=FEATURES, labelCol="label"),
        "multinomial_bayes": NaiveBayes(featuresCol=FEATURES, labelCol="label"),  # fails on negative inputs
        "factorization_machine": FMClassifier(featuresCol=FEATURES, labelCol="label", seed=seed),
    }


# --- adversarial validation (DRF1, DRF2) ------------------------------------------------------------------

@dataclass
class DriftReport:
    importance: DataFrame    # (feature, gain, weight)
    summary: DataFrame       # (metric, value): accuracy, auc, majority_share, n_rounds


def adversarial_validation(train: DataFrame, scoring: DataFrame, features: list[str], key: str, seed: int = 78,
                           max_rounds: int = 50_000, patience: int = 15, threshold: float = 0.5) -> DriftReport:
    """Stack both sources, learn to tell them apart (target = source flag), and report how well
    that works (accuracy near the majority share = same distribution) and which features carry
    the difference."""
    spark = train.sparkSession
    both = (train.select(key, *features).withColumn("label", F.lit(0.0))
            .unionByName(scoring.select(key, *features).withColumn("label", F.lit(1.0))))
    fit_part, hold_part = holdout(both, key, 0.2, seed)
    boosted = boost_with_patience(fit_part, hold_part, features, max_rounds=max_rounds, patience=patience)
    scored = materialize(boosted.model.transform(hold_part).select(  # scored once for both measures
        "label", F.col("prediction").alias("score"), (F.col("prediction") > threshold).cast("double").alias("pred")))
    acc_auc = scored.agg(metrics.accuracy_expr("label", "pred").alias("accuracy")).first()["accuracy"]
    auc = metrics.auc(scored, "score", "label").first()["auc"]
    share = both.agg(F.avg("label")).first()[0]
    importance = spark.createDataFrame([(f, float(g), int(n)) for f, (g, n) in boosted.model.importance().items()],
                                       "feature string, gain double, weight int")
    n_rounds = len(boosted.model.trees)
    summary = spark.createDataFrame(
        [("accuracy", float(acc_auc)), ("auc", float(auc)), ("majority_share", float(max(share, 1 - share))),
         ("n_rounds", float(n_rounds))], "metric string, value double")
    return DriftReport(importance, summary)
