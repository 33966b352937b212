"""One-hot encoding with a fitted value list (ENC1, ENC2); ordered target statistics (MOD5).

The value list is fitted once (``fit_one_hot``) and then applied to any frame, so the scoring
rows can never change the output schema.  All dummy columns are produced by a single
``select`` (a ``withColumn`` chain would grow the plan quadratically).  A null gives all zeros.
Column names follow ``<column>_<value>`` with the value printed as Spark prints it
(``0.5`` for doubles, ``1`` for integers).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.operators import stats
from tabwright.operators.groups import join_back
from tabwright.operators.numbering import row_number_within
from tabwright.operators.split import key_hash_int
from tabwright.session import materialize


@dataclass(frozen=True)
class OneHotModel:
    categories: dict = field(default_factory=dict)  # column -> sorted list of values (as text)

    def dummy_names(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def apply(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        dummies = [F.when(F.col(c).cast("string") == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_{v}")
                   for c, vs in self.categories.items() for v in vs]
        kept = [F.col(c) for c in df.columns if keep_source or c not in self.categories]
        return df.select(*kept, *dummies)


def fit_one_hot(df: DataFrame, cols: list[str], fit_on=None) -> OneHotModel:
    src = df if fit_on is None else df.filter(fit_on)
    return OneHotModel(stats.category_values(src, cols))


def value_index(df: DataFrame, col: str) -> DataFrame:
    """``value, idx``: the distinct non-null values of a column, numbered from 0 in ascending order.  The table stays
    on the executors, whatever its size."""
    values = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    return row_number_within(values, ["value"], name="idx")


def sparse_one_hot(df: DataFrame, col: str, index: DataFrame, out: str, row_id: str) -> DataFrame:
    """Adds ``<out>_idx`` (null: a null or unknown value) and ``out``, a sparse vector with a one at that place."""
    size = index.agg(F.max("idx")).first()[0]
    size = 0 if size is None else size + 1
    place = index.select(F.col("value").alias(col), F.col("idx").alias(f"{out}_idx"))
    joined = join_back(df, place, [col], row_id)
    # the encoder's last, "invalid" category takes the rows without a place, and gives them no one
    known = joined.withColumn("__i", F.coalesce(F.col(f"{out}_idx"), F.lit(size)).cast("double"))
    names = known.select("__i").unionByName(df.sparkSession.createDataFrame([(float(size),)], "__i double"))
    model = OneHotEncoder(inputCols=["__i"], outputCols=[out], dropLast=True).fit(names)
    return model.transform(known).drop("__i")


def ordered_target_mean(df: DataFrame, col: str, label: str, key: str, out: str, weight: float = 1.0, seed: int = 0) -> DataFrame:
    """Adds the ordered target statistic of a category: the mean label of the rows of the same category that come
    earlier in the order of a hash of ``key`` (unique), drawn to the mean of all labels by ``weight`` rows.  A row's own
    label is never in its statistic.  Rows without a label come last, so they see all labels of their category; a null is a
    category; a table without labels gives nulls.

    The rows are range-partitioned by (category, order), so a hot category spans many partitions; sums inside a
    partition are windows, and the partitions before it add one row per category and partition."""
    h, pid, name = "__tw_h", "__tw_pid", "__tw_c"
    prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    by = [F.col(name), F.col(label).isNull(), F.col(h), F.col(key)]
    placed = materialize(df.withColumn(h, key_hash_int(key, seed)).withColumn(name, F.col(col)).repartitionByRange(*by)
                         .withColumn(pid, F.spark_partition_id()))  # range bounds are sampled: kept once
    y = F.col(label).cast("double")
    earlier = Window.partitionBy(pid, name).orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumns({"__s": F.sum(y).over(earlier), "__n": F.count(y).over(earlier)})
    before = Window.partitionBy(name).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy(name, pid).agg(F.sum(y).alias("s"), F.count(y).alias("n"))
             .select(F.col(name).alias("__pc"), F.col(pid).alias("__pp"), F.sum("s").over(before).alias("__ps"), F.sum("n").over(before).alias("__pn")))
    total = lambda a, b: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
    return (inside.join(parts, (F.col(pid) == F.col("__pp")) & F.col(name).eqNullSafe(F.col("__pc")))
            .withColumn(out, (total("__s", "__ps") + F.lit(weight) * F.lit(prior).cast("double")) / (total("__n", "__pn") + F.lit(weight)))
            .drop(h, pid, name, "__s", "__n", "__ps", "__pn", "__pc", "__pp"))


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    """ENC2: the columns still of string type (one-hot them, leave numbers alone)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
