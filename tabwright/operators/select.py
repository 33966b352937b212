"""Feature selection by ANOVA F (TOP1) and dropping drifting features (DRF3).

F per feature from one ``groupBy(label)`` pass that keeps count, mean and population variance
of every feature per class (numerically stable merges, map-side partial aggregation):

    SSW = sum_c n_c * var_c        SSB = sum_c n_c * (mean_c - mean)^2
    F   = (SSB / (C - 1)) / (SSW / (N - C))

The per-class table has one row per class, so the remaining arithmetic runs on a table whose
size is fixed by the number of classes times the number of features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, f_value) for each feature; null when the within-class spread is zero."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(features):
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m{i}"), F.var_pop(F.col(f).cast("double")).alias(f"v{i}")]
    per_class = df.filter(F.col(label).isNotNull()).groupBy(label).agg(*aggs)
    long = per_class.select("n", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("var"))
        for i, f in enumerate(features)])).alias("s")).select("n", "s.*")
    # Window sums over the per-class rows of each feature (a table of classes x features rows)
    # keep this to one read of the input: no join back onto a second evaluation of per_class.
    w = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    terms = long.select("feature", "n", "var", (F.col("mean") - grand).alias("dev"),
                        F.sum("n").over(w).alias("n_total"), F.count(F.lit(1)).over(w).alias("n_classes"))
    ssb = terms.groupBy("feature").agg(
        F.sum(F.col("n") * F.col("dev") * F.col("dev")).alias("ssb"), F.sum(F.col("n") * F.col("var")).alias("ssw"),
        F.first("n_total").alias("n_total"), F.first("n_classes").alias("n_classes"))
    f_value = F.try_divide(F.col("ssb") / (F.col("n_classes") - 1),
                           F.col("ssw") / (F.col("n_total") - F.col("n_classes")))
    return ssb.select("feature", f_value.alias("f_value"))


def rank_features(scores: DataFrame, k: int, score_col: str = "f_value") -> DataFrame:
    """Rank by score (highest first, name breaks ties) and flag the top ``min(k, n)``.
    The window has no partition key, which is fine here: one row per feature."""
    w = Window.orderBy(F.desc_nulls_last(score_col), F.asc("feature"))
    return (scores.withColumn("rank", F.row_number().over(w))
            .withColumn("selected", (F.col("rank") <= k).cast("int")))


def select_k_best(df: DataFrame, features: list[str], label: str, k: int) -> list[str]:
    """Names of the k best features (all of them when k >= number of features), in input order."""
    if k >= len(features):
        return list(features)
    chosen = {r["feature"] for r in rank_features(anova_f(df, features, label), k)
              .filter("selected = 1").select("feature").collect()}
    return [f for f in features if f in chosen]


def drop_drifting(df: DataFrame, drifting) -> DataFrame:
    """DRF3: drop the named columns, or those whose importance row passes a threshold when
    ``drifting`` is ``(report, threshold)``: the drift report's rows (feature, gain, ...)."""
    if isinstance(drifting, tuple):
        imp, thr = drifting
        names = [r["feature"] for r in imp.filter(F.col("gain") > thr).select("feature").collect()]
    else:
        names = list(drifting)
    return df.drop(*names)
