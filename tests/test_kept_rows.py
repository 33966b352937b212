"""The hold-out's sides are read from one kept copy, and forests keep every row's nodes."""

import random

from pyspark.sql import functions as F

from tabwright.plans import models
from tabwright.plans import models_registry as R


def _prepared(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, float(rnd.randrange(5)), float(rnd.randrange(7)), 1.0, 0.0, None if i % 9 == 0 else float(rnd.random() < 0.5))
            for i in range(400)]
    return spark.createDataFrame(rows, "person_id long, a double, b double, family_size double, is_test double, label double")


def test_holdout_sides_are_kept_for_one_source_at_a_time(spark, monkeypatch, tmp_path):
    calls = {}
    for name in ("one", "two"):
        spark.range(3).write.parquet(str(tmp_path / name))
        calls[str(tmp_path / name)] = _prepared(spark, name)
    monkeypatch.setattr(R, "prepared", lambda spark, sf: calls[sf])
    one, two = calls
    _, feats, tr, ho = R._train_holdout(spark, one)
    assert feats == ["a", "b"] and tr.storageLevel.useMemory and ho.storageLevel.useMemory
    want = models.holdout(calls[one].filter("label is not null"), R.KEY, 0.2, 42)
    for got, rows in zip((tr, ho), want, strict=True):
        assert sorted(got.collect()) == sorted(rows.select(*got.columns).collect()) and got.count()
    assert R._train_holdout(spark, one)[2] is tr
    other = R._train_holdout(spark, two)[2]
    assert other.storageLevel.useMemory and not tr.storageLevel.useMemory and not ho.storageLevel.useMemory
    again = R._train_holdout(spark, one)
    assert again[2].storageLevel.useMemory and not other.storageLevel.useMemory
    for x in again[2:]:
        x.unpersist()


def test_forest_that_keeps_nodes_is_the_same_forest(spark):
    df = _prepared(spark, 3).filter("label is not null").repartition(3, "person_id").sortWithinPartitions("person_id")
    assert models.random_forest().getCacheNodeIds()
    scores = []
    for keep in (True, False):
        m = models.pipeline(["a", "b"], models.random_forest(keep_nodes=keep), k=25).fit(df)
        scores.append(sorted(models.score(m, df, "person_id").select("person_id", F.col("score")).collect()))
    assert scores[0] == scores[1]


def test_fill_reads_written_rows_not_the_joins_of_the_group_label(spark, monkeypatch):
    from tabwright.plans import prepare as P
    ports = list(P.FIXTURE_PORT_CODES)
    rows = [(i, i % 3 == 0 and 1 or 0, None if i % 3 == 0 else float(i % 2), i % 20, "BUILDING", ports[i % 5], float(i),
             None if i % 5 == 0 else float(i % 50), i % 12, i % 7, f"Customer#{i % 20}", "male", i % 3 + 1) for i in range(120)]
    df = spark.createDataFrame(rows, "person_id long, is_test int, label double, family_key long, cabin_raw string, port_raw string, "
                                     "fare_raw double, age_raw double, ticket_group_key int, n_relatives long, name_raw string, "
                                     "sex_raw string, class_raw int")
    seen, fill = [], P.impute.impute_chained

    def watched(d, *args, **kw):
        seen.append(d._jdf.queryExecution().optimizedPlan().toString())
        return fill(d, *args, **kw)

    monkeypatch.setattr(P.impute, "impute_chained", watched)
    out = P.prepare(df)
    assert len(seen) == 1 and "Join" not in seen[0]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    plain = P.prepare(df, checkpoint=False)

    def rounded(d):
        return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect()], key=lambda r: r[0])

    assert out.columns == plain.columns and rounded(out) == rounded(plain)
    assert out.filter("age is null").count() == 0


def test_spark_estimators_of_the_cv_board_read_few_partitions(spark, monkeypatch):
    """Trees send a sum per open node and partition, and steps cost a task a partition, so rows are gathered first."""
    rows = [(i, float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, a double, b double, label double").repartition(24)
    seen, real = [], models.cross_val_accuracy
    monkeypatch.setattr(models, "cross_val_accuracy", lambda d, *a, **b: seen.append(d) or real(d, *a, **b))
    board = models.cv_leaderboard(df, ["a", "b"], {"tree": models.decision_tree()}, "k").collect()
    assert [(r.model, r.error) for r in board] == [("tree", None)] and board[0].mean_accuracy == 1.0
    assert seen[0].rdd.getNumPartitions() == models.LEAST_GATHERED and seen[0].count() == 200
    assert models.gathered(df.coalesce(2)).rdd.getNumPartitions() == 2  # few are left as they are
    monkeypatch.setattr(models, "ROWS_GATHERED", 20)
    assert models.gathered(df).rdd.getNumPartitions() == 10


def test_the_cv_board_gathers_moments_once_a_fold(spark, monkeypatch):
    df = _prepared(spark, 5).where("label is not null")
    single = {kind: models.cross_val_accuracy(models.kfold(df, "person_id", 3, 1), ["a", "b"], models.Discriminant(kind), "fold", 3)
              .agg(F.avg("accuracy")).first()[0] for kind in models.KINDS}
    seen, real = [], models.class_moments
    monkeypatch.setattr(models, "class_moments", lambda *a: seen.append(a) or real(*a))
    board = models.cv_leaderboard(df, ["a", "b"], {kind: models.Discriminant(kind) for kind in models.KINDS}, "person_id")
    assert {r.model: r.mean_accuracy for r in board.collect()} == single
    assert len(seen) == 3
