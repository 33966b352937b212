"""Fitted statistics (AGG1-AGG5, AGG10-AGG12) returned as plain Python scalars.

Each statistic is one aggregate over the table and comes back as a few numbers, never a table:

* mode: ``groupBy(value).count()`` (map-side partial counts) and a distributed top-1 ordered by
  count descending, value ascending (ties -> smallest value, as the reference's ``mode()[0]``).
* exact median / quantile: values are counted (``groupBy(value).count()``, so ties cost one row),
  the distinct values are range-partitioned, per-partition totals give every partition its offset,
  and only the partitions that hold the wanted ranks are read again (:func:`values_at_ranks`).
  Equals linear interpolation between the two order statistics around ``(n - 1) * q`` (pandas
  ``median``, SQL ``quantile_cont``).  One path at every size; two values per quantile come back.
* category lists: one pass that emits (column, value) pairs and ``distinct``; the lists become
  columns of the encoded table, so the table's own width bounds them.
* :func:`fit_many` fits any number of the above together in at most three passes over the
  table, which is what the fitting code paths use; the single-statistic functions remain for
  direct use and as references in the tests.

NaN counts as missing in every statistic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.session import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _present(df: DataFrame, col: str, where: Column | None = None) -> Column:
    """The column with NaN as null, null outside ``where``."""
    x = F.col(col)
    if isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        x = F.when(~F.isnan(x), x)
    return x if where is None else F.when(where, x)


def _restrict(df: DataFrame, col: str, where: Column | None) -> DataFrame:
    return df.select(_present(df, col, where).alias("v")).filter(F.col("v").isNotNull())


def mode_value(df: DataFrame, col: str, where: Column | None = None):
    """Most frequent non-null value; ties go to the smallest value."""
    rows = (_restrict(df, col, where).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("v")).limit(1).collect())
    return rows[0]["v"] if rows else None


def values_at_ranks(counts: DataFrame, ranks: dict[int, set[int]]) -> dict[tuple[int, int], float]:
    """Values at 0-based ranks.  ``counts``: ``c`` (column number), ``v`` (distinct value), ``n`` (its
    rows); ``ranks`` maps a column number to the wanted ranks.  The distinct values stay on the
    executors; one row per wanted rank comes back."""
    wanted = [(c, k) for c, ks in ranks.items() for k in sorted(ks)]
    if not wanted:
        return {}
    spark = counts.sparkSession
    # range bounds come from sampling: written once, so totals and lookups see one layout
    laid = materialize(counts.repartitionByRange("c", "v").withColumn("pid", F.spark_partition_id()))
    totals = laid.groupBy("c", "pid").agg(F.sum("n").alias("total"))
    # a row per column and partition
    before = F.coalesce(F.sum("total").over(
        Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    want = F.broadcast(spark.createDataFrame(wanted, "c int, k long"))
    place = (totals.withColumn("before", before).join(want, "c")
             .where((F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("total")))
             .select("c", "pid", "before", "k"))
    inside = F.sum("n").over(Window.partitionBy("c", "pid", "k").orderBy("v"))
    rows = (laid.join(F.broadcast(place), ["c", "pid"]).withColumn("upto", F.col("before") + inside)
            .where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
            .select("c", "k", "v").collect())
    return {(r["c"], r["k"]): r["v"] for r in rows}


def _neighbours(n: int, q: float) -> tuple[int, int, float]:
    pos = (n - 1) * q
    return math.floor(pos), math.ceil(pos), pos - math.floor(pos)


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, where: Column | None = None):
    """Exact linear-interpolated quantile of the non-null (and non-NaN) values."""
    return fit_many(df, {"q": (("quantile", q), col, where)})["q"]


def exact_median(df: DataFrame, col: str, where: Column | None = None):
    return exact_quantile(df, col, 0.5, where)


def fit_many(df: DataFrame, spec: dict) -> dict:
    """Several statistics in a fixed number of passes, whatever their number.

    ``spec`` maps a name to ``(kind, column, where)``; kind is ``count``, ``mean``, ``min``,
    ``max``, ``std_pop``, ``std_samp``, ``mode``, ``median`` or ``("quantile", q)``; ``where`` (a
    Column or None) restricts the rows.

    * pass 1: one aggregate with every count, mean, extreme and deviation, and the row count
      behind every quantile;
    * pass 2: all modes at once with GROUPING SETS (one set per column), ranked by count
      descending then value ascending, top row per set (a per-task group limit runs before the
      shuffle, so at most one row per set and task moves);
    * pass 3: the distinct values of all quantile columns with their counts, then
      :func:`values_at_ranks` on those.
    """
    def restricted(col, where):
        return _present(df, col, where)

    def qof(kind):
        if kind == "median":
            return 0.5
        if isinstance(kind, tuple) and kind[0] == "quantile":
            return float(kind[1])
        return None

    simple = {"count": F.count, "mean": F.avg, "min": F.min, "max": F.max,
              "std_pop": F.stddev_pop, "std_samp": F.stddev_samp}
    out: dict = {}
    p1 = []
    quantiles = []           # (name, col, where, q, count alias)
    counted: dict = {}       # (col, where text) -> count alias
    for name, (kind, col, where) in spec.items():
        x = restricted(col, where)
        q = qof(kind)
        if q is not None:
            k = (col, str(where))
            if k not in counted:
                counted[k] = f"__cnt{len(counted)}"
                p1.append(F.count(x.cast("double")).alias(counted[k]))
            quantiles.append((name, col, where, q, counted[k]))
        elif kind in simple:
            p1.append(simple[kind](x).alias(name))
    first = df.agg(*p1).first() if p1 else None
    for name, (kind, _, _) in spec.items():
        if kind in simple:
            out[name] = first[name]

    modes = [(name, col, where) for name, (kind, col, where) in spec.items() if kind == "mode"]
    if modes:
        cols = [f"__m{i}" for i in range(len(modes))]
        sel = df.select(*[restricted(col, where).alias(c) for (_, col, where), c in zip(modes, cols)])
        g = sel.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
            F.count(F.lit(1)).alias("__n"), *[F.grouping(c).alias(f"__g{i}") for i, c in enumerate(cols)])
        own = F.coalesce(*[F.when(F.col(f"__g{i}") == 0, F.lit(i)) for i in range(len(cols))])
        valid = F.coalesce(*[F.when(F.col(f"__g{i}") == 0, F.col(c).isNotNull()) for i, c in enumerate(cols)])
        w = Window.partitionBy("__set").orderBy(F.desc("__n"), *[F.asc(c) for c in cols])
        top = (g.withColumn("__set", own).filter(valid)
               .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
               .select("__set", *cols).collect())
        found = {r["__set"]: r[cols[r["__set"]]] for r in top}
        for i, (name, _, _) in enumerate(modes):
            out[name] = found.get(i)

    wanted: dict[int, set[int]] = {}
    stacked = {}             # count alias -> (number, col, where)
    for _, col, where, q, cnt in quantiles:
        if first[cnt]:
            number = stacked.setdefault(cnt, (len(stacked), col, where))[0]
            wanted.setdefault(number, set()).update(_neighbours(first[cnt], q)[:2])
    if stacked:
        counts = (df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("c"), restricted(col, where).cast("double").alias("v"))
            for i, col, where in stacked.values()])).alias("x"))
            .select("x.c", "x.v").where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
        at = values_at_ranks(counts, wanted)
    for name, _, _, q, cnt in quantiles:
        if not first[cnt]:
            out[name] = None
            continue
        k1, k2, part = _neighbours(first[cnt], q)
        a, b = at[stacked[cnt][0], k1], at[stacked[cnt][0], k2]
        out[name] = float(a + (b - a) * part)
    return out


def moments(df: DataFrame, cols: list[str], where: Column | None = None) -> dict:
    """Mean and population standard deviation of each column in one pass."""
    got = fit_many(df, {**{f"{c}__mean": ("mean", c, where) for c in cols},
                        **{f"{c}__std": ("std_pop", c, where) for c in cols}})
    return {c: (got[f"{c}__mean"], got[f"{c}__std"]) for c in cols}


def mean_value(df: DataFrame, col: str, where: Column | None = None):
    return df.agg(F.avg(_present(df, col, where))).first()[0]


def _sort_key(value: str, numeric: bool):
    if numeric:
        try:
            return (0, float(value), value)
        except ValueError:
            pass
    return (1, 0.0, value)


def category_values(df: DataFrame, cols: list[str], max_values: int = 10_000) -> dict[str, list[str]]:
    """Sorted distinct non-null values of each column (as strings), in one pass.  The list becomes column names, so more
    than ``max_values`` in all are an error (``encode.sparse_one_hot`` takes any number)."""
    pairs = (df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols
             ])).alias("p"))
             .select("p.name", "p.value").filter(F.col("value").isNotNull()).distinct())
    rows = pairs.limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} values in {', '.join(cols)}: use encode.sparse_one_hot")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r["name"]].append(r["value"])
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        numeric = isinstance(types.get(c), NUMERIC)
        out[c].sort(key=lambda v, nm=numeric: _sort_key(v, nm))
    return out


def summary_exact(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column (rows = statistics), fitted
    together by :func:`fit_many`."""
    spark = df.sparkSession
    spec = {}
    for c in cols:
        spec.update({f"{c}|count": ("count", c, None), f"{c}|mean": ("mean", c, None),
                     f"{c}|std": ("std_samp", c, None), f"{c}|min": ("min", c, None), f"{c}|max": ("max", c, None),
                     f"{c}|q25": (("quantile", 0.25), c, None), f"{c}|q50": ("median", c, None),
                     f"{c}|q75": (("quantile", 0.75), c, None)})
    got = fit_many(df, spec)

    def num(v):
        return None if v is None else float(v)
    rows = [(c, *[num(got[f"{c}|{k}"]) for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")])
            for c in cols]
    schema = ("column string, count double, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")
    return spark.createDataFrame(rows, schema)
