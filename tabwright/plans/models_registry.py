"""Model-based queries (rows-only checks): fitted on the prepared people table.

The prepared table is built once per Spark application and source folder and reused by these
queries (it is a checkpointed table, so reuse does not grow any lineage).
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import history, metrics
from tabwright.operators import perceptron as nets
from tabwright.operators.impute import impute_chained, impute_forest, reimpute_out_of_range
from tabwright.operators.select import drop_drifting
from tabwright.operators.split import stratified_kfold
from tabwright.plans import models
from tabwright.plans.registry import AGE_DIGITS, sql_least_squares
from tabwright.plans.prepare import materialize, prepare
from tabwright.session import laid_out, scratch_path
from tabwright.sources import io
from tabwright.sources.people import people, with_people

KEY = "person_id"
# DRF3: the features the adversarial check found drifting in the reference, by our names
DRIFTING = ["family_size", "is_test"]
THRESHOLD_BOOST = 0.4   # boosted-regression threshold of the reference
THRESHOLD = 0.5
THRESHOLD_NET = 0.4     # the reference's net counts a label above it

_cache: dict = {}
_kept: dict = {}        # application -> the training and hold-out rows that it keeps


def _app(spark: SparkSession):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 — no local SparkContext
        return id(spark)


def _version(spark: SparkSession, sf: str) -> tuple:
    """The application and the state of the source folder's files (paths, sizes, times)."""
    files = spark.read.format("binaryFile").load(f"{sf.rstrip('/')}/*.parquet")
    state = files.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0]
    return _app(spark), sf, state


def _shared(spark: SparkSession, sf: str, name: str, build):
    """One build per application, state of the source folder and name, shared by the queries that report on it."""
    k = (*_version(spark, sf), name)
    if k not in _cache:
        _cache[k] = build()
    return _cache[k]


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return _shared(spark, sf, "prepared", lambda: laid_out(models.ml_names(prepare(people(spark, sf))), KEY, written=True))


def _features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (KEY, "label")]


def _train_holdout(spark, sf):
    """The prepared rows, their features, and the labelled rows' two sides.  Every fit and score reads a side several times, so
    the sides are kept after the first time, those of one source at a time."""
    prep = drop_drifting(prepared(spark, sf), DRIFTING)
    feats = _features(prep)
    sides = _shared(spark, sf, "holdout", lambda: models.holdout(prep.filter(F.col("label").isNotNull()), KEY, 0.2, 42))
    app = _app(spark)
    if _kept.get(app) is not sides:
        for old in _kept.get(app, ()):
            old.unpersist()
        _kept.clear()  # what an ended application kept went with it
        _kept[app] = sides
        for x in sides:
            x.persist(StorageLevel.MEMORY_AND_DISK)
    return prep, feats, *sides


def q_model_random_forest(spark, sf):
    """MOD1 + PIP1 (selector k=25, all kept when fewer) scored on the hold-out."""
    _, feats, tr, ho = _train_holdout(spark, sf)
    m = models.pipeline(feats, models.random_forest(), k=25).fit(tr)
    return models.score(m, ho, KEY, THRESHOLD)


def q_model_soft_vote(spark, sf):
    """ENS1: GBT + RF + histogram boosting, soft vote 1:1:1."""
    _, feats, tr, ho = _train_holdout(spark, sf)
    voter = models.fit_soft_voter(tr, feats, {"gbt": models.gradient_boosting(), "rf": models.random_forest(),
                                              "hist": models.hist_boosting()}, {"gbt": 1, "rf": 1, "hist": 1}, k=25)
    return voter.transform(ho, KEY, THRESHOLD)


def _boost(spark, sf):
    _, feats, tr, ho = _train_holdout(spark, sf)
    return _shared(spark, sf, "boost", lambda: models.boost_with_patience(tr, ho, feats, patience=15))


def q_model_boost_rounds(spark, sf):
    """MOD4 + EVL7: per-round train/eval rmse of boosted regression with patience 15."""
    pb = _boost(spark, sf)
    return pb.rounds.withColumn("stop_round", F.lit(pb.stop_round)).withColumn("best_round", F.lit(pb.best_round))


def q_model_boost_predictions(spark, sf):
    """MOD4 + MTH3: boosted-regression score thresholded at 0.4 (strictly above)."""
    _, _, _, ho = _train_holdout(spark, sf)
    pb = _boost(spark, sf)
    out = pb.model.transform(ho)
    return out.select(KEY, "label", F.col("prediction").alias("score"),
                      (F.col("prediction") > THRESHOLD_BOOST).cast("int").alias("prediction"))


def q_model_reweighted(spark, sf):
    """LDB2: reweighted stumps, randomised trees and five nearest neighbours, each on every hold-out row."""
    _, feats, tr, ho = _train_holdout(spark, sf)
    fitted = models.fit_models(tr, feats, {"adaboost": models.AdaBoost(), "extra_trees": models.ExtraTrees(),
                                           "nearest_neighbours": models.NearestNeighbours()})
    scored = None
    for name, m in fitted.items():
        if isinstance(m, Exception):
            raise m
        rows = models.score(m, ho, KEY, THRESHOLD).withColumn("model", F.lit(name))
        scored = rows if scored is None else scored.unionByName(rows)
    return scored


def _board_estimators(n_rows):
    est = {"random_forest": models.random_forest(), "gradient_boosting": models.gradient_boosting(),
           "logistic_regression": models.logistic(c=1.0, n_rows=n_rows), "decision_tree": models.decision_tree(),
           "perceptron": models.perceptron(hidden=(50, 50)), "hist_boosting": models.hist_boosting()}
    est.update(models.boosting_presets())
    return est


def q_model_leaderboard(spark, sf):
    """LDB1 + SRT1 + EVL6: fixed model list on the hold-out, best first."""
    _, feats, tr, ho = _train_holdout(spark, sf)
    board = models.leaderboard(tr, ho, feats, _board_estimators(tr.count()), KEY, THRESHOLD)
    return board.withColumn("score_percent", F.round(F.col("accuracy") * 100, 2))


def q_model_all_classifiers(spark, sf):
    """LDB2: every Spark classifier with the reference library's defaults, ranked by mean 3-fold accuracy; failures are rows
    with their error."""
    _, feats, tr, _ = _train_holdout(spark, sf)
    return models.cv_leaderboard(tr, feats, models.all_classifiers(tr.count()), KEY)


# the reference's second forest grid, searched with 32 folds
FOREST_32 = {"rounds": [100, 200, 300], "depth": [4, 6, 8], "impurity": ["gini", "entropy"]}


def _folds(spark, sf):
    _, feats, tr, _ = _train_holdout(spark, sf)
    return feats, _shared(spark, sf, "folds", lambda: materialize(stratified_kfold(
        stratified_kfold(tr, KEY, "label", 5), KEY, "label", 32, out="fold32")))


def _tuned(spark, sf):
    """GRD1: the grids of all seven families over 5 stratified folds; rows and best estimators."""
    feats, folds = _folds(spark, sf)
    return _shared(spark, sf, "tuned", lambda: models.tune(
        folds, feats, models.tuning_grids(folds.count()), key=KEY))


def _tuned_voter(spark, sf):
    """The best model of every family, fitted on all training rows."""
    _, feats, tr, _ = _train_holdout(spark, sf)
    return _shared(spark, sf, "tuned_voter", lambda: models.fit_soft_voter(tr, feats, _tuned(spark, sf)[1]))


def q_model_results_table(spark, sf):
    """EVL6 + AGG14: the seven tuned models and their soft vote on the hold-out, with the gain over
    the worst row."""
    _, _, _, ho = _train_holdout(spark, sf)
    voter = _tuned_voter(spark, sf)
    scored = {n: models.score(m, ho, KEY, THRESHOLD) for n, m in voter.models.items()}
    scored["ensemble"] = voter.transform(ho, KEY, THRESHOLD)
    return models.results_table(scored)


def q_model_grid_search(spark, sf):
    """GRD1 (+ SPL3, SPL4): the grids of all seven model families over 5 stratified folds, and the
    second forest grid over 32; the best point by accuracy has rank 1."""
    feats, folds = _folds(spark, sf)
    rows, _ = _tuned(spark, sf)
    more, _ = models.forest_grid(folds, feats, models.Forest(), FOREST_32, "fold32", 32, KEY)
    return spark.createDataFrame(rows + [("random_forest", 32, *x) for x in more],
                                 "model string, folds int, params string, mean_accuracy double, rank int")


def q_model_cross_val(spark, sf):
    """CV1 + AGG13: accuracy of the soft vote over the tuned models on each of 5 stratified folds,
    and mean / population std over folds."""
    feats, folds = _folds(spark, sf)
    scores = models.cross_val_accuracy(folds, feats, _tuned(spark, sf)[1], "fold", 5)
    mean, std = scores.agg(F.avg("accuracy"), F.stddev_pop("accuracy")).first()
    return scores.withColumn("mean_accuracy", F.lit(mean)).withColumn("std_accuracy", F.lit(std))


def q_model_perceptron_history(spark, sf):
    """MOD9 + EVL8 + WIN5: loss and accuracy per epoch of the five-layer net on training and hold-out rows, and the
    mean of the last 10 losses."""
    _, feats, tr, ho = _train_holdout(spark, sf)
    scored = nets.epoch_scores(tr, ho, feats, models.perceptron(epochs=100), threshold=THRESHOLD_NET)
    tail = history.tail_mean(scored, "set", ["epoch"], "loss", 10, 3)
    return scored.join(tail, "set")


def _drift(spark, sf):
    prep = prepared(spark, sf)
    feats = [c for c in _features(prep) if c != "is_test"]
    return _shared(spark, sf, "drift", lambda: models.adversarial_validation(
        prep.filter("is_test = 0"), prep.filter("is_test = 1"), feats, KEY))


def q_drift_importance(spark, sf):
    """DRF1 + DRF2: feature importances (gain, split count) of the source-telling model."""
    return _drift(spark, sf).importance


def q_drift_summary(spark, sf):
    """DRF1: accuracy / AUC of telling the sources apart, next to the majority share."""
    return _drift(spark, sf).summary


def q_drift_reduced_features(spark, sf):
    """DRF3 + PRJ8: the prepared table without the drifting features."""
    out = drop_drifting(prepared(spark, sf), DRIFTING)
    return out.withColumn("age", F.round("age", AGE_DIGITS))


def q_drift_reduced_by_gain(spark, sf):
    """DRF2 -> DRF3: the prepared table without the features whose measured gain is a fifth and more."""
    return drop_drifting(prepared(spark, sf), (_drift(spark, sf).importance, 0.2))


def q_impute_age_chained(spark, sf):
    """IMP6: chained regression of age on several columns, clipped to [0, 80]."""
    p = materialize(people(spark, sf).select(KEY, F.col("age_raw").alias("age"),
                                 F.col("class_raw").cast("double").alias("pclass"),
                                 F.col("n_relatives").cast("double").alias("relatives"),
                                 F.col("ticket_group_key").cast("double").alias("month")))
    out = impute_chained(p, ["age"], ["pclass", "relatives", "month"], max_iter=20, lo=0.0, hi=80.0)
    return out.select(KEY, F.round("age", AGE_DIGITS).alias("age"))


def q_impute_age_bayesian(spark, sf):
    """IMP6: age by Bayesian ridge on several columns, clipped to [0, 80]."""
    p = materialize(people(spark, sf).select(KEY, F.col("age_raw").alias("age"),
                                 F.col("class_raw").cast("double").alias("pclass"),
                                 F.col("n_relatives").cast("double").alias("relatives"),
                                 F.col("ticket_group_key").cast("double").alias("month")))
    out = impute_chained(p, ["age"], ["pclass", "relatives", "month"], max_iter=20, lo=0.0, hi=80.0, bayesian=True)
    return out.select(KEY, F.round("age", AGE_DIGITS).alias("age"))


def q_impute_age_chained_train_fit(spark, sf):
    """IMP7: the same fitted on labelled rows only, applied to all rows."""
    p = materialize(people(spark, sf).select(KEY, "is_test", F.col("age_raw").alias("age"),
                                 F.col("class_raw").cast("double").alias("pclass"),
                                 F.col("n_relatives").cast("double").alias("relatives")))
    out = impute_chained(p, ["age"], ["pclass", "relatives"], lo=0.0, hi=80.0, fit_on=F.col("is_test") == 0)
    return out.select(KEY, F.round("age", AGE_DIGITS).alias("age"))


def q_impute_age_refill(spark, sf):
    """UPD4 + FLT1: ages outside [0, 40] are cleared and filled again by chained regression."""
    p = materialize(people(spark, sf).select(KEY, F.col("age_raw").alias("age"),
                                 F.col("class_raw").cast("double").alias("pclass"),
                                 F.col("n_relatives").cast("double").alias("relatives")))
    out = reimpute_out_of_range(p, "age", ["pclass", "relatives"], 0.0, 40.0)
    return out.select(KEY, F.round("age", AGE_DIGITS).alias("age"))


def q_impute_age_forest(spark, sf):
    """IMP8: 100-tree forest regression of age on class, sex, relatives."""
    p = laid_out(people(spark, sf).select(KEY, F.col("age_raw").alias("age"),
                                 F.col("class_raw").cast("double").alias("pclass"),
                                 F.col("sex_raw").alias("sex"),
                                 F.col("n_relatives").cast("double").alias("relatives")), KEY)
    out = impute_forest(p, "age", ["pclass", "sex", "relatives"], num_trees=100, seed=0)
    return out.select(KEY, F.round("age", AGE_DIGITS).alias("age"))


def q_submission(spark, sf):
    """SNK3 + EVL9: forest fitted on all labelled rows, scoring rows -> (id, label)."""
    prep = drop_drifting(prepared(spark, sf), DRIFTING)
    feats = _features(prep)
    m = models.pipeline(feats, models.random_forest(), k=25).fit(prep.filter(F.col("label").isNotNull()))
    scored = models.score(m, prep.filter(F.col("label").isNull()), KEY, THRESHOLD, keep=())
    return io.submission(scored, KEY, "prediction", "label")


def q_run_log(spark, sf):
    """SNK5: the parameters and the input's profile of a run appended to a run-log table (partitioned
    by day), read back.  The run id is a hash of what the run is, so a repeated run has the same."""
    path = scratch_path(spark, "run-log")
    n = people(spark, sf).agg(F.count(F.lit(1)).alias("rows"), F.count("label").alias("labelled"),
                              F.sum("label").cast("long").alias("positive")).first()
    params = {**n.asDict(), "model": "random_forest", "num_trees": 26, "max_depth": 10,
              "threshold": THRESHOLD, "holdout_fraction": 0.2, "seed": 42}
    text = ";".join(f"{k}={v}" for k, v in params.items())
    run_id = hashlib.md5(text.encode()).hexdigest()[:12]
    io.append_run_log(io.run_log_frame(spark, run_id, params), path)
    return spark.read.parquet(path).select("run_id", "key", "value")


SQL_RUN_LOG = with_people("""
WITH n AS (SELECT count(*) AS r, count(label) AS l, CAST(sum(label) AS BIGINT) AS p FROM people),
v AS (SELECT unnest([{'k': 'rows', 'v': CAST(r AS VARCHAR)}, {'k': 'labelled', 'v': CAST(l AS VARCHAR)},
                     {'k': 'positive', 'v': CAST(p AS VARCHAR)}, {'k': 'model', 'v': 'random_forest'},
                     {'k': 'num_trees', 'v': '26'}, {'k': 'max_depth', 'v': '10'}, {'k': 'threshold', 'v': '0.5'},
                     {'k': 'holdout_fraction', 'v': '0.2'}, {'k': 'seed', 'v': '42'}]) AS x,
             substr(md5('rows=' || r || ';labelled=' || l || ';positive=' || p || ';model=random_forest;num_trees=26;'
                        || 'max_depth=10;threshold=0.5;holdout_fraction=0.2;seed=42'), 1, 12) AS run_id FROM n)
SELECT run_id, x.k AS key, x.v AS value FROM v""")


# DRF3 with an explicit list has an exact SQL form: the flagship's columns minus the drifting ones.
def _sql_drift_reduced() -> str:
    from tabwright.plans.registry import SQL_PREPARE_FEATURES
    cols = (["person_id", "title_0", "class_1", "class_2", "class_3"]
            + [f'"family_survival_{v}" AS family_survival_{v.replace(".", "_")}' for v in ("0.0", "0.5", "1.0")]
            + ["cabin_0", "cabin_1", "cabin_5", "cabin_8", "sex", "n_relatives", "age",
               "label"])
    return f"WITH x AS ({SQL_PREPARE_FEATURES}) SELECT {', '.join(cols)} FROM x"


def _sql_age(xs: dict, where: str = "true", cleared: str = "age_raw", hi: float = 80.0) -> str:
    """One incomplete column: the chained fill is one least-squares fit."""
    table, pred = sql_least_squares("v", "age", list(xs), where)
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {n}" for n, c in xs.items())
    return with_people(f"""
WITH v AS (SELECT person_id, is_test, CAST({cleared} AS DOUBLE) AS age, {cols} FROM people), s AS {table}
SELECT person_id, round(coalesce(age, greatest(least({pred}, {hi}), 0.0)), {AGE_DIGITS}) AS age FROM v, s""")


SQL_MODEL_QUERIES = {
    "drift_reduced_features": (q_drift_reduced_features, _sql_drift_reduced()),
    "run_log": (q_run_log, SQL_RUN_LOG),
    "impute_age_chained": (q_impute_age_chained, _sql_age(
        {"pclass": "class_raw", "relatives": "n_relatives", "month": "ticket_group_key"})),
    "impute_age_chained_train_fit": (q_impute_age_chained_train_fit, _sql_age(
        {"pclass": "class_raw", "relatives": "n_relatives"}, "is_test = 0")),
    "impute_age_refill": (q_impute_age_refill, _sql_age(
        {"pclass": "class_raw", "relatives": "n_relatives"}, hi=40.0,
        cleared="CASE WHEN age_raw BETWEEN 0 AND 40 THEN age_raw END")),
}


def q_stream_submission(spark, sf):
    """Streaming SNK3: scoring rows arrive as parquet files (two drops), a file-stream query
    scores each micro-batch with the fitted forest and appends submission rows; the sink is read
    back."""
    from tabwright.operators.split import key_hash_int
    from tabwright.streaming.scoring import score_stream
    prep = drop_drifting(prepared(spark, sf), DRIFTING)
    feats = _features(prep)
    model = models.pipeline(feats, models.random_forest(), k=25).fit(prep.filter(F.col("label").isNotNull()))
    scoring = prep.filter(F.col("label").isNull()).drop("label")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    for part in (0, 1):  # two file drops
        scoring.filter(key_hash_int(KEY, 7) % 2 == part).write.parquet(f"{src}/drop={part}")
    q = score_stream(spark, f"{src}/*", scoring.schema, model, KEY, sink, ckpt, THRESHOLD)
    q.awaitTermination()
    return spark.read.parquet(sink).select(KEY, "label")


MODEL_QUERIES = {
    "model_random_forest": q_model_random_forest,
    "model_soft_vote": q_model_soft_vote,
    "model_boost_rounds": q_model_boost_rounds,
    "model_boost_predictions": q_model_boost_predictions,
    "model_leaderboard": q_model_leaderboard,
    "model_reweighted": q_model_reweighted,
    "model_all_classifiers": q_model_all_classifiers,
    "model_results_table": q_model_results_table,
    "model_grid_search": q_model_grid_search,
    "model_cross_val": q_model_cross_val,
    "model_perceptron_history": q_model_perceptron_history,
    "drift_importance": q_drift_importance,
    "drift_summary": q_drift_summary,
    "impute_age_bayesian": q_impute_age_bayesian,
    "impute_age_forest": q_impute_age_forest,
    "drift_reduced_by_gain": q_drift_reduced_by_gain,
    "submission": q_submission,
    "stream_submission": q_stream_submission,
}
