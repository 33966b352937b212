"""Group-unanimity rules (RUL1-RUL4, JN3, JN4, FLT4, FLT5).

A *family* is a surname shared by at least two rows.  Two member sets are formed inside
families: women and children (age <= child_age or sex = female) and adult men (age >
child_age and sex = male).  For each set the mean label per surname is computed over labelled
rows; surnames whose mean equals a chosen value form a rule list.  A rule is
``(member set, mean to match, value to assign)``; the reference uses the means in both senses
in different snapshots, so both numbers are parameters.

Rule lists are tables (one row per surname) joined by key; they are never collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.fixed import CHILD_AGE
from tabwright.operators.groups import join_back, require_unique
from tabwright.session import materialize


@dataclass(frozen=True)
class Rule:
    members: str        # "women_children" | "adult_men"
    match_mean: float   # mean label of the set within the family
    assign: float       # value given to the matched rows


# Filling rules as in the rule-filter step: unanimous outcomes are copied to unlabelled members.
FILL_RULES = (Rule("women_children", 0.0, 0.0), Rule("adult_men", 1.0, 1.0))
# The exported override table takes the means in the other sense.
COPY_RULES = (Rule("women_children", 1.0, 0.0), Rule("adult_men", 0.0, 1.0))


def member_condition(members: str, sex: str, age: str, child_age: float = CHILD_AGE,
                     female: str = "female", male: str = "male") -> Column:
    if members == "women_children":
        return (F.col(age) <= child_age) | (F.col(sex) == female)
    if members == "adult_men":
        return (F.col(age) > child_age) & (F.col(sex) == male)
    raise ValueError(members)


def rule_lists(df: DataFrame, surname: str, label: str, sex: str, age: str, rules=FILL_RULES,
               child_age: float = CHILD_AGE, labelled_only: bool = True) -> DataFrame:
    """RUL1: table (surname, rule_index, assign) of surnames matched by each rule, from one aggregate
    per surname (its rows, and the mean label of every rule's member set).

    ``labelled_only`` applies FLT4 first (labels other than 0/1 do not take part)."""
    seen = F.col(label).isin(0.0, 1.0) if labelled_only else F.col(label).isNotNull()
    means = [F.avg(F.when(seen & member_condition(r.members, sex, age, child_age), F.col(label))).alias(f"__mean{i}")
             for i, r in enumerate(rules)]
    fam = (df.where(F.col(surname).isNotNull()).groupBy(surname).agg(F.count(F.lit(1)).alias("__n"), *means)
           .where(F.col("__n") >= 2))
    hits = F.array(*[F.when(F.col(f"__mean{i}") == float(r.match_mean), F.struct(
        F.lit(i).alias("rule_index"), F.lit(float(r.assign)).alias("assign"))) for i, r in enumerate(rules)])
    return (fam.select(surname, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("x"))
            .select(surname, "x.rule_index", "x.assign"))


def _rule_value(df: DataFrame, lists: DataFrame, surname: str, row_id: str) -> DataFrame:
    """Attach ``__rule``: the assigned value of the last matching rule (later rules win)."""
    best = (lists.groupBy(surname)
            .agg(F.max_by("assign", "rule_index").alias("__rule")))
    return join_back(df, best, [surname], row_id)


def fill_by_rules(df: DataFrame, lists: DataFrame, surname: str, label: str, out: str | None = None, *,
                  row_id: str) -> DataFrame:
    """RUL2: a null label of a listed surname takes the rule's value."""
    out = out or label
    j = _rule_value(df, lists, surname, row_id)
    return j.withColumn(out, F.when(F.col(label).isNull() & F.col("__rule").isNotNull(), F.col("__rule"))
                        .otherwise(F.col(label))).drop("__rule")


def rewrite_by_rules(df: DataFrame, lists: DataFrame, surname: str, label: str, rewrites: dict, *,
                     row_id: str) -> DataFrame:
    """RUL3: for unlabelled rows of listed surnames, overwrite features so a model follows the rule.
    ``rewrites`` maps an assigned value to ``{column: new value}``."""
    j = _rule_value(df, lists, surname, row_id)
    unl = F.col(label).isNull()
    cols = sorted({c for upd in rewrites.values() for c in upd})
    exprs = {}
    for c in cols:
        e = None
        for assign, upd in rewrites.items():
            if c in upd:
                cond = unl & (F.col("__rule") == float(assign))
                e = F.when(cond, F.lit(upd[c])) if e is None else e.when(cond, F.lit(upd[c]))
        exprs[c] = e.otherwise(F.col(c))
    return j.withColumns(exprs).drop("__rule")


def override_table(df: DataFrame, lists: DataFrame, key: str, surname: str, out: str = "rule") -> DataFrame:
    """RUL4: (key, rule) for every row: -1 when no rule applies, else the assigned 0/1."""
    j = _rule_value(df.select(key, surname), lists, surname, key)
    return j.select(key, F.coalesce(F.col("__rule").cast("int"), F.lit(-1)).alias(out))


def apply_overrides(pred: DataFrame, overrides: DataFrame, key: str, pred_col: str = "prediction",
                    rule_col: str = "rule") -> DataFrame:
    """JN4: where the override table has a rule (not -1) for the key, it replaces the prediction.
    A key that occurs twice in the table is an error."""
    overrides = materialize(overrides.select(key, rule_col))
    require_unique(overrides, [key], "apply_overrides")
    return (pred.join(overrides.select(key, rule_col), key, "left")
            .withColumn(pred_col, F.coalesce(F.nullif(F.col(rule_col), F.lit(-1)), F.col(pred_col)))
            .drop(rule_col))


def in_key_set(df: DataFrame, keys: DataFrame, col: str, out: str, row_id: str) -> DataFrame:
    """FLT5 / JN3 as a flag: whether ``col`` is in the key table (a distinct left join)."""
    k = keys.select(F.col(col)).distinct().withColumn(out, F.lit(True))
    return join_back(df, k, [col], row_id).withColumn(out, F.coalesce(F.col(out), F.lit(False)))
