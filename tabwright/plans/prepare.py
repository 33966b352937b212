"""Feature preparation of the people table (the reference's main preparation script).

Order of work, as in the reference:

1. cabin: first letter, missing -> "M", letter -> code
2. port: missing -> mode, then code by dictionary
3. ticket: first digit run, missing -> mode (z-score over all rows where it is a feature)
4. sex code; honorific from the name, rare ones collapsed, code (unmapped -> 0)
5. fare: missing -> median (z-score where it is a feature)
6. two-pass leave-one-out group label: pass 1 on ``group_keys1``, pass 2 on the ticket
7. family size = relatives + 1, binned
8. age: chained regression fill on several columns, clipped to [0, 80]
9. one-hot of title, class, group label, cabin, port with fitted value lists
10. feature selection by prefix + plain columns, cast to double, label and key kept; on request a
    final scaler, fitted on the labelled rows

The snapshots of the preparation differ in these options only: ``onehot`` and ``feature_prefixes``
(port dummies, one-hot bins), ``plain_features``, ``scale_features``, ``fit_on_train_only``.

Fitted statistics are gathered by small aggregates over a checkpointed copy of the input (the
lineage is cut once, so every statistic reads the same materialised rows instead of re-running
the joins behind the input).  The result is a lazy plan; only the statistics ran.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import codes, text
from tabwright.functions.fixed import (AGE_CLIP, CABIN_CODES, MISSING_CABIN, RARE_TITLES, SEX_CODES,
                                       TITLE_CODES, TITLE_DEFAULT)
from tabwright.operators import groups, impute
from tabwright.operators.encode import fit_one_hot
from tabwright.operators.scale import fit_zscore
from tabwright.session import materialize  # noqa: F401  (re-exported)

# The people view's priorities play the part of the port of embarkation.
FIXTURE_PORT_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4}


@dataclass(frozen=True)
class PrepareConfig:
    key: str = "person_id"
    label: str = "label"
    flag: str = "is_test"
    cabin: str = "cabin_raw"
    port: str = "port_raw"
    port_codes: dict = field(default_factory=lambda: dict(FIXTURE_PORT_CODES))
    ticket: str = "name_raw"
    name: str = "name_raw"
    sex: str = "sex_raw"
    fare: str = "fare_raw"
    age: str = "age_raw"
    pclass: str = "class_raw"
    relatives: str = "n_relatives"
    group_keys1: tuple = ("family_key", "ticket_group_key")
    age_method: str = "chained"              # "chained" | "forest"
    # Of the reference's six predictors the title is constant on the people view and the family size
    # is the relatives plus one, so neither changes a least-squares fit; relatives come as one column.
    age_predictors: tuple = ("class", "port", "n_relatives")
    fit_on_train_only: bool = False          # False = statistics over labelled + scoring rows
    onehot: tuple = ("title", "class", "family_survival", "cabin", "port")
    feature_prefixes: tuple = ("class_", "title_", "family_survival_", "cabin_")
    plain_features: tuple = ("sex", "n_relatives", "family_size", "is_test", "age")
    scale_features: tuple = ()               # z-scored at the end, fitted on labelled rows


def prepare(people: DataFrame, cfg: PrepareConfig = PrepareConfig(), checkpoint: bool = True) -> DataFrame:
    c = cfg
    fit_on = (F.col(c.flag) == 0) if c.fit_on_train_only else None
    df = materialize(people) if checkpoint else people

    # 1-4: row-local recodes (one projection)
    df = df.withColumns({
        "cabin": codes.lookup(F.coalesce(text.first_char(c.cabin), F.lit(MISSING_CABIN)), CABIN_CODES),
        "ticket_digits": text.first_digits(c.ticket),
        "sex": codes.lookup(c.sex, SEX_CODES),
        "title": codes.lookup(codes.collapse(text.honorific(c.name), RARE_TITLES), TITLE_CODES, TITLE_DEFAULT),
        "class": F.col(c.pclass),
    })
    # level-1 statistics: modes and the median
    fills = impute.fit_fill(df, {c.port: "mode", "ticket_digits": "mode", c.fare: "median"}, fit_on)
    df = fills.apply(df)
    df = df.withColumns({
        "port": codes.lookup(c.port, c.port_codes),
        "ticket": F.col("ticket_digits").cast("double"),
        "fare": F.col(c.fare).cast("double"),
    })
    # level-2 statistics: z-scores, where they are features
    scaled = [x for x in ("ticket", "fare") if f"{x}_std" in c.plain_features]
    if scaled:
        z = fit_zscore(df, scaled, fit_on)
        df = df.withColumns({f"{x}_std": z.expr(x) for x in scaled})

    # 6: group label, two passes (pass 2 groups by ticket number)
    df = groups.loo_two_pass(df, list(c.group_keys1), ["ticket_digits"], c.label, out="family_survival",
                              row_id=c.key)
    # two aggregations and joins: write the rows once, so the fits below read them instead of recomputing it
    df = materialize(df) if checkpoint else df

    # 7: family size and its bin
    df = df.withColumn("family_size", F.col(c.relatives) + 1)
    df = df.withColumn("family_size_bin", codes.family_size_bin("family_size"))

    # 8: age
    lo, hi = AGE_CLIP
    df = df.withColumn("age", F.col(c.age).cast("double"))
    if c.age_method == "chained":
        df = impute.impute_chained(df, ["age"], list(c.age_predictors), lo=lo, hi=hi, fit_on=fit_on)
    elif c.age_method == "forest":
        df = impute.impute_forest(df, "age", list(c.age_predictors), fit_on=fit_on)
        df = materialize(df) if checkpoint else df  # the chained fill has written its rows already
    else:
        raise ValueError(c.age_method)
    # a negative age would be refilled; the clip above already rules it out

    # 9: one-hot with fitted value lists
    oh = fit_one_hot(df, list(c.onehot), fit_on)
    df = oh.apply(df)

    # 10: selection, cast, final scaler
    dummies = [n for n in oh.dummy_names() if n.startswith(tuple(c.feature_prefixes))]
    feats = [text.qcol(n).cast("double").alias(n) for n in dummies + list(c.plain_features)]
    out = df.select(F.col(c.key), *feats, F.col(c.label))
    if c.scale_features:
        z = fit_zscore(out, list(c.scale_features), F.col("is_test") == 0)
        out = z.apply(out)
    return out


def prepared_feature_names(prepared: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> list[str]:
    return [n for n in prepared.columns if n not in (cfg.key, cfg.label)]
