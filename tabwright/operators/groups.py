"""Group-aware features (WIN1-WIN3, JN2, ENC3).

All of them are "aggregate per key, join back": ``groupBy`` gets map-side partial aggregation,
so a hot key costs one partial row per task before the shuffle, and the join back is an
equi-join that AQE can split when one key is skewed.  Rows whose key is null never enter the
exchange (in the reference such rows are dropped by ``groupby`` and keep their default); they
are routed around the join and stacked back, so a large null group cannot pile into one task.

Leave-one-out group label, set form: for a row with label ``y`` in a group with ``n1`` ones and
``n0`` zeros, the *other* members hold ``n1 - [y = 1]`` ones and ``n0 - [y = 0]`` zeros
(unlabelled rows count in neither).  "max of others is 1" is "others hold a one", "min of
others is 0" is "others hold a zero".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialize


def _valid(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


_SALT = "__tw_salt"


def _salted(df: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """An extra join key: 0 for rows with a complete key, a positive hash of the row's id for rows
    with a null in the key.  Per-key tables only hold 0, so null-key rows never match, and they
    spread over all join partitions instead of piling up in the partition of "null".  The salt is
    a function of the row, so a retried task sends every row to the same partition again."""
    return df.withColumn(_SALT, F.when(_valid(keys), F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64(F.col(row_id)), F.lit(2 ** 30)) + 1))


def attach_group_stats(df: DataFrame, keys: list[str], aggs: list[Column], row_id: str) -> DataFrame:
    """Join per-key aggregates back onto every row (null key -> null statistics); ``row_id`` is a
    column of many values that spreads the null-key rows."""
    keys = list(keys)
    salted = _salted(df, keys, row_id)
    # The salt is a grouping column here (not a literal), so it stays a join key and the
    # exchange hashes on it; a literal 0 would be folded into a join condition instead.
    per_key = salted.filter(F.col(_SALT) == 0).groupBy(*keys, _SALT).agg(*aggs)
    stat_cols = [c for c in per_key.columns if c not in keys and c != _SALT]
    out = salted.join(per_key, keys + [_SALT], "left")
    return out.select(*[F.col(c) for c in df.columns], *[F.col(c) for c in stat_cols])


def require_unique(table: DataFrame, keys: list[str], what: str) -> None:
    """Raise when a key occurs twice: a join would pick or multiply rows."""
    twice = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{what}: key {[twice[0][k] for k in keys]} occurs {twice[0]['n']} times")


def join_back(df: DataFrame, table: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Left join of a per-key table (one row per key, checked) onto every row of ``df``, null keys
    salted as in :func:`attach_group_stats`.  The table is written first: both join inputs are then
    plain shuffles, and AQE can split a hot key on the side of ``df``."""
    keys = list(keys)
    right = materialize(table.where(_valid(keys)).withColumn(_SALT, F.lit(0).cast("long")))
    require_unique(right, keys, "join_back")
    return _salted(df, keys, row_id).join(right, keys + [_SALT], "left").drop(_SALT)


def group_size(df: DataFrame, keys, out: str = "group_size", *, row_id: str) -> DataFrame:
    """WIN3 / JN2: number of rows sharing the key (null key -> null)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return attach_group_stats(df, keys, [F.count(F.lit(1)).alias(out)], row_id)


def _is(label: str, v: float, visible: Column | None = None) -> Column:
    hit = F.col(label) == v
    if visible is not None:
        hit = hit & visible
    return F.when(hit, 1).otherwise(0)


def loo_group_label(df: DataFrame, keys, label: str, out: str = "group_label", default: float = 0.5,
                    prev: str | None = None, visible: Column | None = None, *, row_id: str) -> DataFrame:
    """Leave-one-out group label.

    Without ``prev`` (pass 1): 1 if another member of the group has label 1, else 0 if another
    member has label 0, else ``default``.
    With ``prev`` (pass 2): rows whose ``prev`` is already 1 keep it; the others become 1 / 0 by
    the same rule, or keep ``prev`` when the other members are unlabelled.
    Null-key rows get ``default`` (pass 1) or keep ``prev`` (pass 2).

    ``visible`` (a row condition) makes the feature fold-aware: only labels of rows where it holds
    count, so hold-out labels cannot leak into the feature (the reference counts every label).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    n1, n0 = "__n1", "__n0"
    with_stats = attach_group_stats(df, keys, [F.sum(_is(label, 1.0, visible)).alias(n1),
                                               F.sum(_is(label, 0.0, visible)).alias(n0)], row_id)
    others1 = F.col(n1) - _is(label, 1.0, visible)
    others0 = F.col(n0) - _is(label, 0.0, visible)
    fallback = F.lit(float(default)) if prev is None else F.col(prev)
    value = F.when(others1 > 0, F.lit(1.0)).when(others0 > 0, F.lit(0.0)).otherwise(fallback)
    if prev is not None:
        value = F.when(F.col(prev) >= 1.0, F.col(prev)).otherwise(value)
    return with_stats.withColumn(out, value.cast("double")).drop(n1, n0)


def loo_two_pass(df: DataFrame, keys1, keys2, label: str, out: str = "group_label",
                 default: float = 0.5, visible: Column | None = None, *, row_id: str) -> DataFrame:
    """WIN1 then WIN2: the reference's family/ticket group label."""
    first = loo_group_label(df, keys1, label, out="__pass1", default=default, visible=visible, row_id=row_id)
    second = loo_group_label(first, keys2, label, out=out, prev="__pass1", visible=visible, row_id=row_id)
    return second.drop("__pass1")
