"""Discriminants against plain numpy, exact AUC against all pairs, sparse one-hot of many values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import metrics, stats
from tabwright.operators.discriminant import KINDS, Discriminant
from tabwright.operators.encode import ordered_target_mean, sparse_one_hot, value_index


def plain(kind, x, y, t):
    """Class of every row of ``t`` and the scores, class by class from the definitions."""
    classes = np.unique(y)
    pooled = sum((y == c).mean() * np.cov(x[y == c].T, bias=True) for c in classes)
    out = []
    for c in classes:
        mine = x[y == c]
        mu, d, prior = mine.mean(axis=0), t - mine.mean(axis=0), np.log((y == c).mean())
        if kind == "nearest_centroid":
            out.append(-(d ** 2).sum(axis=1))
        elif kind == "naive_bayes":
            var = mine.var(axis=0) + 1e-9 * x.var(axis=0).max()
            out.append(prior - 0.5 * (np.log(2 * np.pi * var) + d ** 2 / var).sum(axis=1))
        else:
            s = pooled if kind == "lda" else np.cov(mine.T)
            det = 0 if kind == "lda" else np.linalg.slogdet(s)[1]
            out.append(prior - 0.5 * det - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    return classes[np.argmax(out, axis=0)], np.array(out)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("n_classes", [2, 3])
def test_discriminants_equal_the_definitions(spark, kind, n_classes):
    rng = np.random.default_rng(4)
    y = rng.integers(0, n_classes, 500).astype(float)
    x = rng.normal(size=(500, 3)) * (1 + y[:, None] / 2) + np.outer(y, [1.0, -0.5, 0.3])
    x[:, 2] += 0.6 * x[:, 0]
    df = spark.createDataFrame([(*map(float, v), float(c), i) for i, (v, c) in enumerate(zip(x, y, strict=True))],
                               "a double, b double, c double, label double, id long").repartition(4)
    m = Discriminant(kind).fit(df.unionByName(df.withColumn("label", F.lit(None).cast("double"))), ["a", "b", "c"])
    got = m.transform(df).orderBy("id").collect()
    want, scores = plain(kind, x, y, x)
    assert [r["prediction"] for r in got] == want.tolist()
    if n_classes == 2:
        np.testing.assert_allclose([r["probability"][1] for r in got], 1 / (1 + np.exp(scores[0] - scores[1])), rtol=1e-9)


def test_discriminants_of_degenerate_tables(spark):
    rows = [(1.0, 2.0, 5.0, 0.0), (1.0, 2.0, 5.0, 0.0), (3.0, 6.0, 5.0, 1.0)]  # collinear, constant, a class of one row
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    for kind in KINDS:
        got = Discriminant(kind).fit(df, ["a", "b", "c"]).transform(df)
        assert [r["prediction"] for r in got.collect()] == [0.0, 0.0, 1.0] or kind in ("lda", "qda")


def test_auc_equals_all_pairs(spark):
    rng = np.random.default_rng(6)
    for n, values in ((400, 5), (400, 10_000), (3, 1)):
        s, y = rng.integers(0, values, n), rng.integers(0, 2, n)
        y[:2] = (0, 1)
        df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y, strict=True)] + [(None, 1), (1.0, None)],
                                   "s double, y int").repartition(7)
        d = s[y == 1][:, None] - s[y == 0][None]
        r = metrics.auc(df, "s", "y").first()
        assert r["auc"] == pytest.approx((d > 0).mean() + (d == 0).mean() / 2, abs=1e-12)
        assert (r["positives"], r["negatives"]) == (int((y == 1).sum()), int((y == 0).sum()))
    assert metrics.auc(df.where("y = 1"), "s", "y").first()["auc"] is None


def test_sparse_one_hot_of_a_million_values(spark):
    df = spark.range(1_000_000).select("id", (F.col("id") * 7 % 1_000_003).alias("key"))
    index = value_index(df, "key")
    out = sparse_one_hot(df.unionByName(spark.createDataFrame([(-1, None), (-2, -5)], "id long, key long")), "key", index, "v", "id")
    few = out.where("id in (-1, -2, 0, 1, 999999)").collect()
    order = sorted(i * 7 % 1_000_003 for i in range(1_000_000))
    assert out.count() == 1_000_002 and len(few) == 5
    for r in few:
        assert r["v"].size == 1_000_000
        if r["id"] < 0:
            assert r["v_idx"] is None and r["v"].indices.tolist() == []
        else:
            assert order[r["v_idx"]] == r["key"] and r["v"].indices.tolist() == [r["v_idx"]] and r["v"].values.tolist() == [1.0]
    with pytest.raises(ValueError, match="sparse_one_hot"):
        stats.category_values(df, ["key"], max_values=100)


@pytest.mark.parametrize("partitions", [3, 16])
def test_ordered_target_means_equal_a_plain_loop(spark, partitions):
    import hashlib
    rng = np.random.default_rng(12)
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"v{rng.integers(0, 40)}",
             None if i % 5 == 0 else int(rng.integers(0, 2)), 0.5) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, c string, y int, n double")  # n: a name of no meaning here
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot category spans several
    try:
        got = {r["id"]: r["t"] for r in ordered_target_mean(df, "c", "y", "id", "t", 2.0, 4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    prior = np.mean([r[2] for r in rows if r[2] is not None])
    seen = {}
    for i, c, y, _ in sorted(rows, key=lambda r: (r[2] is None, int(hashlib.md5(f"{r[0]}:4".encode()).hexdigest()[:8], 16), r[0])):
        s, n = seen.get(c, (0, 0))
        assert got[i] == pytest.approx((s + 2 * prior) / (n + 2), rel=1e-12)
        if y is not None:
            seen[c] = s + y, n + 1
    assert len(got) == 1500
    bare = ordered_target_mean(df.withColumn("y", F.lit(None).cast("int")), "c", "y", "id", "t")
    assert bare.where("t is not null").count() == 0 and ordered_target_mean(df.where("false"), "c", "y", "id", "t").count() == 0
