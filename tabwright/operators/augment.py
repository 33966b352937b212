"""Mixup augmentation (AUG1, SMP2, TOP2, MTH6, UNI3).

Rows are numbered 0..n-1 in key order (distributed range sort).  Each of the first ``num``
rows gets a partner row number from a hash of its key (uniform in [0, n)), the partner is found
by an equi-join on the row number, and the mixed row is ``alpha * x_i + (1 - alpha) * x_j`` for
every feature and for the label.  Mixed rows are stacked under the originals with
``is_synthetic = 1`` and the partner's key.  ``alpha`` is a fixed weight, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.fixed import MIXUP
from tabwright.functions.codes import convex
from tabwright.operators.numbering import row_number_within
from tabwright.operators.split import key_hash_int


def mixup(df: DataFrame, key: str, features: list[str], label: str, alpha: float = MIXUP["alpha"], num: int = MIXUP["num"],
          seed: int = MIXUP["seed"]) -> DataFrame:
    base = df.select(key, *features, label)
    n = base.count()
    if n == 0:
        return base.withColumn("partner_key", F.lit(None).cast(base.schema[key].dataType)) \
                   .withColumn("is_synthetic", F.lit(0))
    numbered = row_number_within(base, [key], name="__rn")
    heads = (numbered.filter(F.col("__rn") < num)
             .withColumn("__prn", key_hash_int(key, seed) % F.lit(n)))
    partners = numbered.select(F.col("__rn").alias("__prn"), F.col(key).alias("partner_key"),
                               *[F.col(c).alias(f"__p_{c}") for c in features + [label]])
    mixed = (heads.join(partners, "__prn")
             .select(F.col(key), *[convex(alpha, c, f"__p_{c}").alias(c) for c in features + [label]],
                     F.col("partner_key"), F.lit(1).alias("is_synthetic")))
    originals = base.select(key, *features, label,
                            F.lit(None).cast(base.schema[key].dataType).alias("partner_key"),
                            F.lit(0).alias("is_synthetic"))
    return originals.unionByName(mixed)
