"""Deterministic splits by key hash (SPL1-SPL4).

A row's side of a split depends only on its key and the seed (``md5("<key>:<seed>")``), never
on partitioning or row order, so the same row lands on the same side in every run, on any
cluster size, and in any SQL engine that has ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.numbering import row_number_within


def key_hash_hex(key: str, seed: int) -> Column:
    """First 8 hex digits of md5("<key>:<seed>") — a uniform 32-bit value as text."""
    return F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8)


def key_hash_int(key: str, seed: int) -> Column:
    return F.conv(key_hash_hex(key, seed), 16, 10).cast("long")


def holdout_flag(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
                 out: str = "is_holdout") -> DataFrame:
    """SPL1: 1 for the hold-out share (``test_fraction`` of the hash range), else 0."""
    return df.withColumn(out, (key_hash_int(key, seed) < F.lit(int(test_fraction * 2 ** 32))).cast("int"))


def kfold(df: DataFrame, key: str, k: int = 3, seed: int = 1, out: str = "fold") -> DataFrame:
    """SPL2: shuffled k-fold by hash modulo k."""
    return df.withColumn(out, (key_hash_int(key, seed) % k).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, out: str = "fold",
                     exact: bool = True) -> DataFrame:
    """SPL3/SPL4: exact stratification — inside each label, rows are ordered by (hash, key) and
    dealt round-robin to the k folds, so fold sizes per label differ by at most one.  The
    numbering is a distributed range sort (a label holding most rows is not one task).

    ``exact=False`` is the shuffle-free approximation: the fold is the key hash modulo k, which
    balances each label's folds only in expectation."""
    if not exact:
        return kfold(df, key, k, seed, out)
    h = "__tw_h"
    numbered = row_number_within(df.withColumn(h, key_hash_int(key, seed)), [h, key], [label], name="__tw_rn")
    return numbered.withColumn(out, (F.col("__tw_rn") % k).cast("int")).drop(h, "__tw_rn")
