"""Operator tests: hand-made cases from the fixtures table, and property tests against plain
Python versions of the same rules on small random tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions import codes, text
from tabwright.operators import groups, history, metrics, select, split, stats
from tabwright.operators.augment import mixup
from tabwright.operators.encode import fit_one_hot
from tabwright.operators.numbering import row_number_within
from tabwright.sources.io import split_sources, union_sources


# --- leave-one-out group label ------------------------------------------------------------------

def _loo_brute(rows, key_idx, prev=None):
    """Nested-loop version of the reference rule (rows: (id, key, label))."""
    out = {}
    for i, (rid, k, y) in enumerate(rows):
        cur = 0.5 if prev is None else prev[rid]
        if k is None:
            out[rid] = cur
            continue
        if prev is not None and cur >= 1:
            out[rid] = cur
            continue
        others = [r[2] for j, r in enumerate(rows) if j != i and r[1] == k and r[2] is not None]
        if others and max(others) == 1.0:
            out[rid] = 1.0
        elif others and min(others) == 0.0:
            out[rid] = 0.0
        else:
            out[rid] = cur
    return out


def test_loo_fixture_cases(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 1.0), (3, "b", None), (4, "c", 0.0), (5, "c", 0.0), (6, "c", None),
         (7, None, 1.0)], "id long, k string, y double")
    got = {r["id"]: r["g"] for r in groups.loo_group_label(df, "k", "y", "g", row_id="id").collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 1.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 0.5}


def test_loo_pass2_never_lowers_one(spark):
    df = spark.createDataFrame([(1, "t", 0.0, 1.0), (2, "t", 0.0, 0.5)], "id long, k string, y double, p double")
    got = {r["id"]: r["g"] for r in groups.loo_group_label(df, "k", "y", "g", prev="p", row_id="id").collect()}
    assert got == {1: 1.0, 2: 0.0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_loo_two_pass_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", "d", None]), rnd.choice(["x", "y", None]),
             rnd.choice([0.0, 1.0, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k1 string, k2 string, y double")
    got = {r["id"]: r["g"] for r in groups.loo_two_pass(df, ["k1"], ["k2"], "y", "g", row_id="id").collect()}
    p1 = _loo_brute([(r[0], r[1], r[3]) for r in rows], 1)
    p2 = _loo_brute([(r[0], r[2], r[3]) for r in rows], 1, prev=p1)
    assert got == p2


def test_group_size_null_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, k string")
    got = {r["id"]: r["n"] for r in groups.group_size(df, "k", "n", row_id="id").collect()}
    assert got == {1: 2, 2: 2, 3: None}


# --- bins, text, codes ----------------------------------------------------------------------------

def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 4, 5, 8, 9, 10, 11]], "s int")
    got = [r[0] for r in df.select(codes.group_size_bin("s")).collect()]
    assert got == [1, 2, 2, 1, 1, None, None, 0]
    df = spark.createDataFrame([(v,) for v in [1, 2, 4, 5, 7, 8]], "s int")
    assert [r[0] for r in df.select(codes.family_size_bin("s")).collect()] == [0, 1, 1, 2, 2, 3]


def test_digits_and_titles(spark):
    df = spark.createDataFrame([("A/5 21171",), ("LINE",), ("330911",)], "t string")
    assert [r[0] for r in df.select(text.first_digits("t")).collect()] == ["5", None, "330911"]
    assert [r[0] for r in df.select(text.last_digits("t")).collect()] == ["21171", None, "330911"]
    names = spark.createDataFrame([("Braund, Mr. Owen",), ("Oliva y Ocana, Dona. Fermina",), ("Nobody",)], "n string")
    assert [r[0] for r in names.select(text.honorific("n")).collect()] == ["Mr", "Dona", None]
    assert [r[0] for r in names.select(text.before_first("n", ",")).collect()] == ["Braund", "Oliva y Ocana", "Nobody"]


def test_lookup_missing_key_is_null(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    assert [r[0] for r in df.select(codes.lookup("c", {"A": 0})).collect()] == [0, None, None]
    assert [r[0] for r in df.select(codes.lookup("c", {"A": 0}, 9)).collect()] == [0, 9, 9]


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert stats.mode_value(df, "v") == "a"


# --- exact quantile -------------------------------------------------------------------------------

@pytest.mark.parametrize("n,q", [(1, 0.5), (2, 0.5), (1001, 0.5), (5000, 0.25), (5000, 0.9)])
def test_exact_quantile_matches_numpy(spark, n, q):
    rnd = np.random.default_rng(n)
    vals = np.round(rnd.normal(50, 20, n), 2)
    vals[::7] = 13.0  # ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = stats.exact_quantile(df, "x", q)
    assert math.isclose(got, float(np.quantile(vals, q)), rel_tol=1e-12, abs_tol=1e-12)


# --- numbering, splits ------------------------------------------------------------------------------

def test_row_numbers_with_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"g{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = {r["id"]: r["rn"] for r in row_number_within(df, ["id"], ["g"], "rn", num_partitions=16).collect()}
    expect = {}
    for g in {r[1] for r in rows}:
        for i, rid in enumerate(sorted(r[0] for r in rows if r[1] == g)):
            expect[rid] = i
    assert got == expect
    glob = {r["id"]: r["rn"] for r in row_number_within(df, ["id"], name="rn", num_partitions=5).collect()}
    assert glob == {i: i for i in range(2000)}


def test_splits_partition_independent(spark):
    df = spark.range(3000).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 2).cast("double"))
    a = {r["k"]: r["is_holdout"] for r in split.holdout_flag(df.repartition(1), "k").collect()}
    b = {r["k"]: r["is_holdout"] for r in split.holdout_flag(df.repartition(8), "k").collect()}
    assert a == b and 0.15 < sum(a.values()) / len(a) < 0.25
    f = split.stratified_kfold(df, "k", "y", 5)
    sizes = f.groupBy("y", "fold").count().collect()
    assert {r["count"] for r in sizes} == {300}


def test_union_then_split_is_identity(spark):
    tr = spark.createDataFrame([(1, 1.0, "x")], "id long, y double, c string")
    te = spark.createDataFrame([(2, "z")], "id long, c string")
    u = union_sources(tr, te)
    assert u.filter("id = 2").first()["y"] is None
    a, b = split_sources(u)
    assert [r["id"] for r in a.collect()] == [1] and [r["id"] for r in b.collect()] == [2]


# --- encoding ---------------------------------------------------------------------------------------

def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b", 0.5), (2, "a", 1.0), (3, None, 0.0)], "id long, c string, f double")
    m = fit_one_hot(df, ["c", "f"])
    assert m.categories == {"c": ["a", "b"], "f": ["0.0", "0.5", "1.0"]}
    out = {r["id"]: r for r in m.apply(df).collect()}
    assert (out[3]["c_a"], out[3]["c_b"]) == (0, 0)
    assert out[1]["c_b"] == 1 and out[1]["f_0.5"] == 1
    for r in out.values():
        assert r["f_0.0"] + r["f_0.5"] + r["f_1.0"] == 1


# --- histories ---------------------------------------------------------------------------------------

def _patience_brute(losses, p, strict=False):
    best, counter, out, stopped = None, 0, [], False
    for v in losses:
        ok = best is None or (v < best if strict else v <= best)
        counter = 0 if ok else counter + 1
        best = v if best is None else min(best, v)
        stop = (not stopped) and counter >= p
        stopped = stopped or stop
        out.append((best, ok, counter, stop))
    return out


def test_patience_fixture_case(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate([5.0, 4.0, 4.0, 6.0, 7.0])],
                               "run int, t int, loss double")
    h = history.patience(df, "run", ["t"], "loss", patience=2).orderBy("step").collect()
    assert [r["counter"] for r in h] == [0, 0, 0, 1, 2]
    assert [r["is_stop"] for r in h] == [False, False, False, False, True]


@pytest.mark.parametrize("strict", [False, True])
def test_patience_two_level_scan_matches_fold(spark, strict):
    rnd = random.Random(7)
    rows = []
    for run in range(3):
        n = 400 if run == 0 else 37  # one long run spanning many chunks
        rows += [(run, t, float(rnd.randint(0, 30))) for t in range(n)]
    df = spark.createDataFrame(rows, "run int, t int, loss double")
    got = history.patience(df, "run", ["t"], "loss", patience=5, strict=strict, chunk_rows=16).collect()
    by = {(r["run"], r["step"]): (r["best"], r["is_ok"], r["counter"], r["is_stop"]) for r in got}
    for run in range(3):
        losses = [v for (rr, t, v) in rows if rr == run]
        for i, exp in enumerate(_patience_brute(losses, 5, strict)):
            assert by[(run, i)] == exp


def test_tail_mean(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(25)], "run int, t int, v double")
    r = history.tail_mean(df, "run", ["t"], "v", 10, 3).first()
    assert r["tail_mean"] == 19.5 and r["n_points"] == 10


# --- selection, augmentation, metrics -------------------------------------------------------------

def test_anova_f_matches_formula(spark):
    rnd = np.random.default_rng(0)
    y = rnd.integers(0, 3, 600)
    x1 = rnd.normal(y, 1.0)
    x2 = rnd.normal(0, 1.0, 600)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, x1, x2)], "y int, x1 double, x2 double")
    got = {r["feature"]: r["f_value"] for r in select.anova_f(df, ["x1", "x2"], "y").collect()}
    for name, x in (("x1", x1), ("x2", x2)):
        groups_ = [x[y == c] for c in range(3)]
        grand = x.mean()
        ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups_)
        ssw = sum(((g - g.mean()) ** 2).sum() for g in groups_)
        assert math.isclose(got[name], (ssb / 2) / (ssw / (600 - 3)), rel_tol=1e-9)
    assert select.select_k_best(df, ["x1", "x2"], "y", 1) == ["x1"]
    assert select.select_k_best(df, ["x1", "x2"], "y", 25) == ["x1", "x2"]


def test_mixup_counts_and_values(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 2)) for i in range(100)], "id long, x double, y double")
    m = mixup(df, "id", ["x"], "y", alpha=0.1, num=30)
    assert m.count() == 130
    mixed = m.filter("is_synthetic = 1").collect()
    assert len(mixed) == 30 and {r["id"] for r in mixed} == set(range(30))
    for r in mixed:
        assert math.isclose(r["x"], 0.1 * r["id"] + 0.9 * r["partner_key"])
    assert mixup(df, "id", ["x"], "y", num=500).count() == 200


def test_metrics(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    m = metrics.binary_metrics(df, "y", "p").first()
    assert m["accuracy"] == 0.7 and math.isclose(m["f1"], 6 / 9)
    assert math.isclose(m["auc_hard"], (0.75 + 4 / 6) / 2)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 4, (0, 1): 2, (1, 0): 1, (1, 1): 3}
    empty = spark.createDataFrame([(0, 0)], "y int, p int")
    assert metrics.binary_metrics(empty, "y", "p").first()["f1"] == 0.0


def test_fit_many_matches_single_statistics(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([9, 10, 10, 9, None]), rnd.choice(["x", "y", None]), rnd.random() * 100) for _ in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    cond = F.col("b") == "x"
    got = stats.fit_many(df, {"ma": ("mode", "a", None), "mb": ("mode", "b", None), "mc": ("mode", "a", cond),
                              "med": ("median", "c", None), "medx": ("median", "c", cond),
                              "mean": ("mean", "c", None), "sd": ("std_pop", "c", cond)})
    assert got["ma"] == stats.mode_value(df, "a") and got["mb"] == stats.mode_value(df, "b")
    assert got["mc"] == stats.mode_value(df, "a", cond)
    assert math.isclose(got["med"], float(np.median([r[2] for r in rows])))
    assert math.isclose(got["medx"], float(np.median([r[2] for r in rows if r[1] == "x"])))
    assert math.isclose(got["sd"], float(np.std([r[2] for r in rows if r[1] == "x"])))
    tie = spark.createDataFrame([(10,), (9,), (10,), (9,)], "a int")
    assert stats.fit_many(tie, {"m": ("mode", "a", None)})["m"] == 9


def test_loo_with_hot_and_null_keys(spark):
    """A third of the rows share one key, a third have no key: same result as the rule applied
    by counting (the set form checked against the loops above)."""
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{rnd.randint(0, 300)}")
        rows.append((i, k, rnd.choice([0.0, 1.0, None])))
    df = spark.createDataFrame(rows, "id long, k string, y double")
    got = {r["id"]: r["g"] for r in groups.loo_group_label(df, "k", "y", "g", row_id="id").collect()}
    ones, zeros = {}, {}
    for _, k, y in rows:
        ones[k] = ones.get(k, 0) + (y == 1.0)
        zeros[k] = zeros.get(k, 0) + (y == 0.0)
    for i, k, y in rows:
        if k is None:
            exp = 0.5
        elif ones[k] - (y == 1.0) > 0:
            exp = 1.0
        elif zeros[k] - (y == 0.0) > 0:
            exp = 0.0
        else:
            exp = 0.5
        assert got[i] == exp


def test_partition_count_does_not_change_results(spark):
    rows = [(i, f"g{i % 13}", float(i % 2)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, g string, y double")
    a = {r["id"]: (r["rn"], r["lab"]) for r in groups.loo_group_label(
        row_number_within(df.repartition(1), ["id"], ["g"], "rn", num_partitions=1), "g", "y", "lab", row_id="id").collect()}
    b = {r["id"]: (r["rn"], r["lab"]) for r in groups.loo_group_label(
        row_number_within(df.repartition(8), ["id"], ["g"], "rn", num_partitions=8), "g", "y", "lab", row_id="id").collect()}
    assert a == b


def test_stratified_approximate_is_hash_fold(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 3).cast("double"))
    a = {r["k"]: r["fold"] for r in split.stratified_kfold(df, "k", "y", 4, 1, exact=False).collect()}
    b = {r["k"]: r["fold"] for r in split.kfold(df, "k", 4, 1).collect()}
    assert a == b and set(a.values()) == {0, 1, 2, 3}


def test_in_key_set_and_join_back_nulls(spark):
    from tabwright.operators.rules import in_key_set
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, s string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "s string")
    got = {r["id"]: r["f"] for r in in_key_set(df, keys, "s", "f", "id").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_chained_imputation_matches_least_squares(spark):
    from tabwright.operators.impute import impute_chained
    rnd = np.random.default_rng(3)
    n = 400
    x1, x2 = rnd.normal(0, 1, n), rnd.normal(5, 2, n)
    y = 10 + 3 * x1 - 2 * x2 + rnd.normal(0, 0.5, n)
    miss = rnd.random(n) < 0.25
    rows = [(i, float(a), float(b), None if m else float(c)) for i, (a, b, c, m) in enumerate(zip(x1, x2, y, miss))]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y double")
    got = {r["id"]: r["y"] for r in impute_chained(df, ["y"], ["x1", "x2"], lo=-5.0, hi=12.0).collect()}
    X = np.column_stack([np.ones(n), x1, x2])
    coef, *_ = np.linalg.lstsq(X[~miss], y[~miss], rcond=None)
    for i in range(n):
        exp = float(np.clip(X[i] @ coef, -5.0, 12.0)) if miss[i] else float(y[i])
        assert math.isclose(got[i], exp, rel_tol=1e-6, abs_tol=1e-6)


def test_adversarial_validation_finds_the_separating_column(spark):
    from tabwright.plans.models import adversarial_validation
    rnd = random.Random(4)
    rows = [(i, float(i % 2), rnd.random(), rnd.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, src double, noise1 double, noise2 double")
    train = df.filter("src = 0").withColumn("shift", F.col("noise1"))
    scoring = df.filter("src = 1").withColumn("shift", F.col("noise1") + 10.0)
    rep = adversarial_validation(train, scoring, ["shift", "noise2"], "id", max_rounds=20, patience=5)
    summary = {r["metric"]: r["value"] for r in rep.summary.collect()}
    assert summary["accuracy"] > 0.95 and summary["auc"] > 0.95
    top = rep.importance.orderBy(F.desc("gain")).first()
    assert top["feature"] == "shift" and top["weight"] >= 1


def test_soft_vote_and_leaderboard_errors(spark):
    from pyspark.ml.classification import NaiveBayes
    from tabwright.plans import models
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, b, 1.0 if a + 0.5 * b + rnd.gauss(0, 0.5) > 0 else 0.0))
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    est = {"lr": models.logistic(c=1.0, n_rows=400), "dt": models.decision_tree(max_depth=3),
           "rf": models.random_forest(num_trees=5, max_depth=3)}
    voter = models.fit_soft_voter(df, ["a", "b"], est, {"lr": 1, "dt": 0, "rf": 1})
    assert set(voter.models) == {"lr", "rf"}
    voted = {r["id"]: r["score"] for r in voter.transform(df, "id").collect()}
    singles = {n: {r["id"]: r["score"] for r in models.score(voter.models[n], df, "id").collect()} for n in ("lr", "rf")}
    for i in range(400):
        assert math.isclose(voted[i], (singles["lr"][i] + singles["rf"][i]) / 2, rel_tol=1e-12)
    board = {r["model"]: r for r in models.leaderboard(
        df, df, ["a", "b"], {"lr": est["lr"], "nb": NaiveBayes(featuresCol="features", labelCol="label")}, "id").collect()}
    assert board["lr"]["accuracy"] > 0.8 and board["lr"]["error"] is None
    assert board["nb"]["accuracy"] is None and board["nb"]["error"]  # negative inputs: kept as an error row


def test_patience_boost_keeps_last_or_best(spark):
    from tabwright.plans import models
    rnd = random.Random(9)
    rows = [(i, rnd.random(), rnd.random(), float(rnd.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    tr, ho = models.holdout(df, "id", 0.3, 1)
    last = models.boost_with_patience(tr, ho, ["a", "b"], max_rounds=40, patience=3, use="last")
    best = models.boost_with_patience(tr, ho, ["a", "b"], max_rounds=40, patience=3, use="best")
    assert last.stop_round is not None  # noise labels: the validation error stops improving
    assert len(last.model.trees) == last.stop_round + 1
    assert len(best.model.trees) == best.best_round + 1
    evals = sorted((r["round"], r["rmse"]) for r in last.rounds.filter("set = 'eval'").collect())
    assert len(evals) == last.stop_round + 1
    assert min(v for _, v in evals) == evals[last.best_round][1]


def test_fit_many_quantiles_and_extremes(spark):
    rnd = np.random.default_rng(12)
    vals = np.round(rnd.normal(0, 5, 777), 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = stats.fit_many(df, {"q1": (("quantile", 0.1), "x", None), "q9": (("quantile", 0.9), "x", None),
                              "med": ("median", "x", None), "lo": ("min", "x", None), "hi": ("max", "x", None),
                              "n": ("count", "x", None), "sd": ("std_samp", "x", None)})
    for name, q in (("q1", 0.1), ("q9", 0.9), ("med", 0.5)):
        assert math.isclose(got[name], float(np.quantile(vals, q)), rel_tol=1e-12, abs_tol=1e-12)
    assert got["lo"] == vals.min() and got["hi"] == vals.max() and got["n"] == 777
    assert math.isclose(got["sd"], float(np.std(vals, ddof=1)), rel_tol=1e-9)


def test_score_stream_is_exactly_once(spark):
    from tabwright.plans import models
    from tabwright.session import scratch_path
    from tabwright.streaming.scoring import score_stream
    rows = [(i, float(i % 7), float(i % 3), float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    model = models.pipeline(["a", "b"], models.logistic(c=1.0, n_rows=200)).fit(df)
    scoring = df.drop("label")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("t-src", "t-sink", "t-ckpt"))
    scoring.filter("id < 100").write.parquet(f"{src}/p=0")
    score_stream(spark, f"{src}/*", scoring.schema, model, "id", sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 100
    score_stream(spark, f"{src}/*", scoring.schema, model, "id", sink, ckpt).awaitTermination()  # replay
    assert spark.read.parquet(sink).count() == 100
    scoring.filter("id >= 100").write.parquet(f"{src}/p=1")
    score_stream(spark, f"{src}/*", scoring.schema, model, "id", sink, ckpt).awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == 200 and out.select("id").distinct().count() == 200


# --- exactness without size switches, repairs --------------------------------------------------

def test_median_of_many_ties(spark):
    df = spark.range(4_000_000).select((F.col("id") % 2).cast("double").alias("x"))
    assert stats.exact_median(df, "x") == 0.5


def test_nan_counts_as_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    got = stats.fit_many(df, {k: (k, "x", None) for k in ("count", "mean", "min", "max", "std_pop", "mode", "median")})
    assert got == {"count": 2, "mean": 2.0, "min": 1.0, "max": 3.0, "std_pop": 1.0, "mode": 1.0, "median": 2.0}


@pytest.mark.parametrize("fraction,low,high", [(1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (0.5, 0.45, 0.55)])
def test_holdout_fraction_bounds(spark, fraction, low, high):
    from tabwright.operators.split import holdout_flag
    share = holdout_flag(spark.range(2000), "id", fraction).agg(F.avg("is_holdout")).first()[0]
    assert low <= share <= high


def test_duplicate_keys_are_refused(spark):
    from tabwright.operators.groups import join_back
    from tabwright.operators.rules import apply_overrides
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError, match="occurs 2 times"):
        join_back(rows, twice, ["k"], "id")
    pred = spark.createDataFrame([(1, 0)], "id long, prediction int")
    with pytest.raises(ValueError, match="occurs 2 times"):
        apply_overrides(pred, spark.createDataFrame([(1, 1), (1, 0)], "id long, rule int"), "id")


def test_missing_shared_folder_is_an_error_on_a_cluster():
    from tabwright.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_patience_over_chunks_and_a_run_that_never_stops(spark):
    rows = [("a", i, float(100 - i)) for i in range(50)] + [("b", i, float(v)) for i, v in enumerate([5, 4, 4, 6, 7, 8, 1])]
    df = spark.createDataFrame(rows, "run string, i int, loss double")
    for chunk_rows in (3, 1000):
        h = history.patience(df, "run", ["i"], "loss", patience=2, chunk_rows=chunk_rows)
        stop = {r["run"]: r["stop_step"] for r in history.stop_points(h, "run").collect()}
        assert stop == {"a": None, "b": 4}
        assert [r["counter"] for r in h.where("run = 'b'").orderBy("i").collect()] == [0, 0, 0, 1, 2, 3, 0]


def test_chained_imputation_stops_on_the_largest_move(spark):
    """Two incomplete columns whose moves cancel in the sum still iterate to the joint fixed point."""
    from tabwright.operators.impute import impute_chained
    rnd = np.random.default_rng(3)
    x = rnd.normal(0, 1, 300)
    a, b = 2 * x + 1, -2 * x + 5
    rows = [(i, float(x[i]), None if i % 5 == 0 else float(a[i]), None if i % 5 == 1 else float(b[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x double, a double, b double")
    got = {r["id"]: (r["a"], r["b"]) for r in impute_chained(df, ["a", "b"], ["x"]).collect()}
    for i in range(300):
        assert abs(got[i][0] - a[i]) < 1e-2 and abs(got[i][1] - b[i]) < 1e-2


def test_drop_drifting_by_measured_gain(spark):
    report = spark.createDataFrame([("moved", 0.9, 10), ("same", 0.02, 3)], "feature string, gain double, weight int")
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id long, moved double, same double")
    from tabwright.operators.select import drop_drifting
    assert drop_drifting(df, (report, 0.1)).columns == ["id", "same"]


def test_grids_are_the_reference_ones():
    from tabwright.plans import models
    from tabwright.plans.models_registry import FOREST_32
    sizes = {n: math.prod(map(len, g.values())) for n, (_, _, g) in models.tuning_grids(100).items()}
    assert sizes == {"random_forest": 12, "logistic_regression": 3, "perceptron": 8, "gradient_boosting": 27,
                     "xgboost_like": 27, "lightgbm_like": 27, "catboost_like": 27}
    assert math.prod(map(len, FOREST_32.values())) == 18
    sweep = models.all_classifiers(100)
    assert sweep["random_forest"].getNumTrees() == 100 and sweep["gbt"].rounds == 100


def test_tuned_models_vote_over_stratified_folds(spark):
    from tabwright.plans import models
    rnd = random.Random(9)
    rows = []
    for i in range(300):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, b, 1.0 if a * b > 0 else 0.0))
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    folds = split.stratified_kfold(df, "id", "label", 5)
    grids = {"dt": ("tree", models.decision_tree(), {"maxDepth": [1, 5]}),
             "dt_too": ("tree", models.decision_tree(), {"maxDepth": [5, 2]}),
             "mlp": ("net", models.perceptron(epochs=60), {"hidden": [(4,), (8, 8)]})}
    found, best = models.tune(folds, ["a", "b"], grids)
    score = {(r[0], r[2]): r[3] for r in found}
    assert len(found) == 6 and score["dt", "maxDepth=5"] == score["dt_too", "maxDepth=5"] > 0.8
    alone = models.cross_val_accuracy(folds, ["a", "b"], models.decision_tree(max_depth=5), "fold", 5).collect()
    assert math.isclose(score["dt", "maxDepth=5"], sum(r["accuracy"] for r in alone) / 5)
    assert best["dt"].getMaxDepth() == 5 and [r[4] for r in found if r[0] == "mlp"] == [1, 2]
    voted = models.cross_val_accuracy(folds, ["a", "b"], best, "fold", 5).collect()
    assert len(voted) == 5 and all(r["accuracy"] > 0.7 for r in voted)
