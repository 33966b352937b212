"""Registered queries: one Spark plan per operator family, each with an equivalent SQL text.

Every query reads the driver's tables (``sf_dir``) in full.  Real-valued outputs that depend on
summation order (means, deviations, regression fills, z-scores) are rounded in both the Spark
plan and the SQL text so the two engines hash equal values.  Row order is never relied on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.functions import codes, text
from tabwright.functions.fixed import (CABIN_CODES, MIXUP, RARE_TITLES, RULE_REWRITES, SEX_CODES, TITLE_CODES,
                                       TITLE_DEFAULT)
from tabwright.operators import groups, history, metrics, rules, select, split, stats
from tabwright.operators.augment import mixup
from tabwright.operators.discriminant import Discriminant
from tabwright.operators.encode import fit_one_hot, ordered_target_mean, sparse_one_hot, value_index
from tabwright.operators.impute import fill_constant, fit_fill
from tabwright.operators.neighbours import neighbours, vote
from tabwright.operators.numbering import row_number_within
from tabwright.operators.scale import ZScoreModel, fill_with_mean
from tabwright.plans import models
from tabwright.plans.prepare import PrepareConfig, materialize, prepare
from tabwright.session import scratch_path
from tabwright.sources import io
from tabwright.sources.people import people, with_people
from tabwright.sources.tables import read_table

Z = 9      # digits kept for z-scores, fills and mixed values
A = 6      # digits kept for averages and test statistics


# --- SQL fragments shared by several oracle texts ---------------------------------------------

def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql_case(expr: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {expr} {arms} END"


def _sql_hash_hex(col: str, seed: int) -> str:
    return f"substr(md5(CAST({col} AS VARCHAR) || ':{seed}'), 1, 8)"


def _sql_hash_int(col: str, seed: int) -> str:
    return f"('0x' || {_sql_hash_hex(col, seed)})::BIGINT"


SQL_TITLE = r"nullif(regexp_extract(name_raw, ' ([A-Za-z]+)\.', 1), '')"
SQL_DIGITS = "nullif(regexp_extract(name_raw, '([0-9]+)', 1), '')"
SQL_WS = "' ' || chr(9) || chr(10) || chr(13)"


# --- sources and union -----------------------------------------------------------------------

def q_people_union(spark: SparkSession, sf: str) -> DataFrame:
    return people(spark, sf, via_union=True)


SQL_PEOPLE_UNION = with_people("SELECT * FROM people")


def q_source_profile(spark, sf):
    p = people(spark, sf)
    return p.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("label").alias("n_label"), F.count("port_raw").alias("n_port"),
        F.count("fare_raw").alias("n_fare"), F.count("age_raw").alias("n_age"),
        F.sum("n_relatives").alias("sum_relatives"), F.round(F.avg("fare_raw"), 4).alias("avg_fare"),
        F.lit(len(p.columns)).alias("n_columns"))


SQL_SOURCE_PROFILE = with_people("""
SELECT is_test, count(*) AS n_rows, count(label) AS n_label, count(port_raw) AS n_port,
       count(fare_raw) AS n_fare, count(age_raw) AS n_age, CAST(sum(n_relatives) AS BIGINT) AS sum_relatives,
       round(avg(fare_raw), 4) AS avg_fare, 13 AS n_columns
FROM people GROUP BY is_test
""")


# --- scalar recodes ----------------------------------------------------------------------------

def q_cabin_codes(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    letter = text.first_char("c_mktsegment")
    return c.select(
        "c_custkey", letter.alias("cabin_letter"),
        codes.lookup(F.coalesce(letter, F.lit("M")), CABIN_CODES).alias("cabin_code"),
        text.first_digits("c_name").alias("name_digits"),
        text.first_digits("c_name").cast("long").alias("name_number"))


SQL_CABIN_CODES = f"""
SELECT c_custkey, substr(c_mktsegment, 1, 1) AS cabin_letter,
       {_sql_case("coalesce(substr(c_mktsegment, 1, 1), 'M')", CABIN_CODES)} AS cabin_code,
       nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS name_digits,
       CAST(nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS BIGINT) AS name_number
FROM customer
"""


def q_url_digits(spark, sf):
    p = read_table(spark, sf, "pages", ["page_id", "url"])
    return p.select("page_id", text.first_digits("url").alias("first_run"), text.last_digits("url").alias("last_run"))


SQL_URL_DIGITS = r"""
SELECT page_id, nullif(regexp_extract(url, '([0-9]+)', 1), '') AS first_run,
       nullif(regexp_extract(url, '([0-9]+)[^0-9]*$', 1), '') AS last_run
FROM pages
"""


def q_doc_titles(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    title = text.honorific("text")
    grp = codes.collapse(title, RARE_TITLES)
    return d.select("doc_id", title.alias("title"), grp.alias("title_group"),
                    codes.lookup(grp, TITLE_CODES, TITLE_DEFAULT).alias("title_code"))


_SQL_DOC_T = r"nullif(regexp_extract(text, ' ([A-Za-z]+)\.', 1), '')"
_SQL_DOC_G = f"CASE WHEN {_SQL_DOC_T} IN ({_sql_list(RARE_TITLES)}) THEN 'Rare' ELSE {_SQL_DOC_T} END"
SQL_DOC_TITLES = f"""
SELECT doc_id, {_SQL_DOC_T} AS title, {_SQL_DOC_G} AS title_group,
       coalesce({_sql_case(_SQL_DOC_G, TITLE_CODES)}, {TITLE_DEFAULT}) AS title_code
FROM documents
"""


def q_part_name_head(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    return p.select("p_partkey", text.before_first("p_name", " ").alias("head"))


SQL_PART_NAME_HEAD = "SELECT p_partkey, split_part(p_name, ' ', 1) AS head FROM part"


# Names as the reference has them, built from customer rows: every mapped title, every rare one, an
# unmapped one and rows without a title; every third ticket has no digits.
_NAME_TITLES = [*[t for t in TITLE_CODES if t != "Rare"], *RARE_TITLES, "Jr"]


def q_name_titles(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    k = (F.col("c_custkey") % (len(_NAME_TITLES) + 1)).cast("int")
    title = F.get(F.array(*[F.lit(t) for t in _NAME_TITLES]), k)
    c = c.select("c_custkey", F.concat(F.lower("c_mktsegment"), F.coalesce(F.concat(F.lit(", "), title, F.lit(". ")), F.lit(" ")),
                                       F.lit("Given")).alias("name"),
                 F.when(F.col("c_custkey") % 3 == 0, F.lit("LINE")).otherwise(F.concat(F.lit("A/5 "), "c_custkey")).alias("ticket"))
    found = text.honorific("name")
    group = codes.collapse(found, RARE_TITLES)
    return c.select("c_custkey", found.alias("title"), group.alias("title_group"),
                    codes.lookup(group, TITLE_CODES, TITLE_DEFAULT).alias("title_code"),
                    text.before_first("name", ",", trim=True).alias("surname"),
                    text.first_digits("ticket").alias("first_run"), text.last_digits("ticket").alias("last_run"))


_SQL_NAME_G = f"CASE WHEN title IN ({_sql_list(RARE_TITLES)}) THEN 'Rare' ELSE title END"
SQL_NAME_TITLES = rf"""
WITH n AS (SELECT c_custkey, c_mktsegment,
                  [{_sql_list(_NAME_TITLES)}][CAST(c_custkey % {len(_NAME_TITLES) + 1} AS INTEGER) + 1] AS t FROM customer),
m AS (SELECT c_custkey, lower(c_mktsegment) || coalesce(', ' || t || '. ', ' ') || 'Given' AS name,
             CASE WHEN c_custkey % 3 = 0 THEN 'LINE' ELSE 'A/5 ' || c_custkey END AS ticket FROM n),
x AS (SELECT *, nullif(regexp_extract(name, ' ([A-Za-z]+)\.', 1), '') AS title FROM m)
SELECT c_custkey, title, {_SQL_NAME_G} AS title_group,
       coalesce({_sql_case(_SQL_NAME_G, TITLE_CODES)}, {TITLE_DEFAULT}) AS title_code,
       trim(split_part(name, ',', 1)) AS surname,
       nullif(regexp_extract(ticket, '([0-9]+)', 1), '') AS first_run,
       nullif(regexp_extract(ticket, '([0-9]+)[^0-9]*$', 1), '') AS last_run
FROM x"""


def q_vote_scores(spark, sf):
    """ENS1 + MTH3 + EVL1 + SRT1 + AGG14 on closed-form member scores: weighted soft vote, thresholds, a
    table of members and ensemble, best first, with the gain over the worst."""
    p = people(spark, sf).filter(F.col("label").isNotNull()).select(
        "label", (F.col("n_relatives") / 8.0).alias("a"), (F.col("class_raw") / 4.0).alias("b"),
        F.when(F.col("sex_raw") == "male", 0.75).otherwise(0.25).alias("c"))
    members = {m: models.ColumnModel(m) for m in "abc"}
    voter = models.SoftVoter(members, {"a": 2.0, "b": 1.0, "c": 1.0})
    limits = {"a": 0.4, "b": 0.5, "c": 0.5}
    scored = {m: models.score(members[m], p, "label", t, keep=()) for m, t in limits.items()}
    scored["ensemble"] = voter.transform(p, "label", 0.5)
    board = models.results_table(scored)
    w = Window.orderBy(F.desc("accuracy"), "model")  # four rows
    return board.select("model", F.round("accuracy", A).alias("accuracy"), F.row_number().over(w).alias("rank"),
                        F.round("gain_over_worst", A).alias("gain_over_worst"))


SQL_VOTE_SCORES = with_people(f"""
WITH p AS (SELECT label, n_relatives / 8.0 AS a, class_raw / 4.0 AS b,
                  CASE WHEN sex_raw = 'male' THEN 0.75 ELSE 0.25 END AS c FROM people WHERE label IS NOT NULL),
e AS (SELECT *, (a * 2 + b + c) / 4 AS ensemble FROM p),
m AS (SELECT 'a' AS model, avg(CAST((a > 0.4) = (label = 1) AS INTEGER)) AS accuracy FROM e
      UNION ALL SELECT 'b', avg(CAST((b > 0.5) = (label = 1) AS INTEGER)) FROM e
      UNION ALL SELECT 'c', avg(CAST((c > 0.5) = (label = 1) AS INTEGER)) FROM e
      UNION ALL SELECT 'ensemble', avg(CAST((ensemble > 0.5) = (label = 1) AS INTEGER)) FROM e)
SELECT model, round(accuracy, {A}) AS accuracy, CAST(row_number() OVER (ORDER BY accuracy DESC, model) AS INTEGER) AS rank,
       round(accuracy - min(accuracy) OVER (), {A}) AS gain_over_worst FROM m""")


def q_member_flags(spark, sf):
    """FLT5 / JN3 as a flag: whether the surname is on a rule list."""
    p = _with_surname(spark, sf)
    lists = _lists(p).select("surname")
    return rules.in_key_set(p, lists, "surname", "listed", "person_id").select("person_id", "listed")


def q_conversation_head(spark, sf):
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    return c.select("conv_id", "turn",
                    F.trim(text.before_first("text", ","), F.lit(" \t\n\r")).alias("head"))


SQL_CONVERSATION_HEAD = f"""
SELECT conv_id, turn, trim(split_part(text, ',', 1), {SQL_WS}) AS head FROM conversations
"""


def q_compound_filter(spark, sf):
    p = people(spark, sf)
    cond = ((F.col("class_raw") >= 2) & ((F.col("age_raw") <= 16) | (F.col("sex_raw") == "female"))
            & F.col("fare_raw").isNotNull())
    return (p.filter(cond)
            .withColumn("flag", F.lit(1))
            .select(F.col("person_id").alias("id"), (F.col("n_relatives") + 1).alias("family_size"),
                    F.col("class_raw").cast("double").alias("class_value"), "flag"))


SQL_COMPOUND_FILTER = with_people("""
SELECT person_id AS id, n_relatives + 1 AS family_size, CAST(class_raw AS DOUBLE) AS class_value, 1 AS flag
FROM people
WHERE class_raw >= 2 AND (age_raw <= 16 OR sex_raw = 'female') AND fare_raw IS NOT NULL
""")


# --- group sizes and bins -----------------------------------------------------------------------

def q_group_size_bins(spark, sf):
    p = people(spark, sf).select("person_id", "family_key", "n_relatives")
    g = groups.group_size(p, "family_key", "group_size", row_id="person_id")
    return g.select("person_id", "family_key", "group_size",
                    codes.group_size_bin("group_size").alias("ticket_bin"),
                    (F.col("n_relatives") + 1).alias("family_size"),
                    codes.family_size_bin(F.col("n_relatives") + 1).alias("family_bin"))


SQL_GROUP_SIZE_BINS = with_people("""
WITH g AS (SELECT family_key, count(*) AS group_size FROM people WHERE family_key IS NOT NULL GROUP BY family_key)
SELECT p.person_id, p.family_key, g.group_size,
       CASE WHEN g.group_size BETWEEN 2 AND 4 THEN 2
            WHEN g.group_size BETWEEN 5 AND 8 OR g.group_size = 1 THEN 1
            WHEN g.group_size >= 11 THEN 0 END AS ticket_bin,
       p.n_relatives + 1 AS family_size,
       CASE WHEN p.n_relatives + 1 = 1 THEN 0 WHEN p.n_relatives + 1 BETWEEN 2 AND 4 THEN 1
            WHEN p.n_relatives + 1 BETWEEN 5 AND 7 THEN 2 WHEN p.n_relatives + 1 >= 8 THEN 3 END AS family_bin
FROM people p LEFT JOIN g ON p.family_key = g.family_key
""")


def q_group_size_freq(spark, sf):
    p = people(spark, sf).select("family_key")
    sizes = p.groupBy("family_key").agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"),
                                           F.sum("group_size").alias("n_rows"))


SQL_GROUP_SIZE_FREQ = with_people("""
WITH s AS (SELECT family_key, count(*) AS group_size FROM people GROUP BY family_key)
SELECT group_size, count(*) AS n_groups, CAST(sum(group_size) AS BIGINT) AS n_rows FROM s GROUP BY group_size
""")


# --- fitted statistics, fills, z-scores, one-hot -------------------------------------------------

def _sub_pop():
    return (F.col("port_raw") == "1-URGENT") & (F.col("class_raw") == 3)

SQL_SUB_POP = "port_raw = '1-URGENT' AND class_raw = 3"


def q_fill_statistics(spark, sf):
    p = materialize(people(spark, sf).select("port_raw", "fare_raw", "age_raw", "class_raw",
                                             text.first_digits("name_raw").alias("ticket")))
    got = stats.fit_many(p, {
        "port_mode": ("mode", "port_raw", None), "ticket_mode": ("mode", "ticket", None),
        "fare_median": ("median", "fare_raw", None), "fare_median_sub": ("median", "fare_raw", _sub_pop()),
        "fare_mean": ("mean", "fare_raw", None), "fare_std_pop": ("std_pop", "fare_raw", None),
        "age_mean": ("mean", "age_raw", None)})
    names = ["port_mode", "ticket_mode", "fare_median", "fare_median_sub", "fare_mean", "fare_std_pop", "age_mean"]
    row = tuple(got[n] if isinstance(got[n], str) else round(got[n], A) for n in names)
    schema = ("port_mode string, ticket_mode string, fare_median double, fare_median_sub double, "
              "fare_mean double, fare_std_pop double, age_mean double")
    return spark.createDataFrame([row], schema)


SQL_FILL_STATISTICS = with_people(f"""
SELECT (SELECT port_raw FROM people WHERE port_raw IS NOT NULL GROUP BY port_raw
        ORDER BY count(*) DESC, port_raw LIMIT 1) AS port_mode,
       (SELECT t FROM (SELECT {SQL_DIGITS} AS t FROM people) WHERE t IS NOT NULL GROUP BY t
        ORDER BY count(*) DESC, t LIMIT 1) AS ticket_mode,
       (SELECT round(quantile_cont(fare_raw, 0.5), {A}) FROM people) AS fare_median,
       (SELECT round(quantile_cont(fare_raw, 0.5), {A}) FROM people WHERE {SQL_SUB_POP}) AS fare_median_sub,
       (SELECT round(avg(fare_raw), {A}) FROM people) AS fare_mean,
       (SELECT round(stddev_pop(fare_raw), {A}) FROM people) AS fare_std_pop,
       (SELECT round(avg(age_raw), {A}) FROM people) AS age_mean
""")


def q_impute_fills(spark, sf):
    p = materialize(people(spark, sf))
    fills = fit_fill(p, {"port_raw": "mode", "fare_raw": "median", "age_raw": "mean"})
    sub = fit_fill(p, {"fare_raw": ("median", _sub_pop())})
    out = fills.apply(p, suffix="_filled")
    out = sub.apply(out, suffix="_sub_filled")
    out = fill_constant(out.withColumn("port_const", F.col("port_raw")), {"port_const": "UNKNOWN"})
    return out.select("person_id", "port_raw_filled", F.round("fare_raw_filled", A).alias("fare_raw_filled"),
                      F.round("fare_raw_sub_filled", A).alias("fare_raw_sub_filled"),
                      F.round("age_raw_filled", Z).alias("age_raw_filled"), "port_const")


SQL_IMPUTE_FILLS = with_people(f"""
WITH s AS (
  SELECT (SELECT port_raw FROM people WHERE port_raw IS NOT NULL GROUP BY port_raw
          ORDER BY count(*) DESC, port_raw LIMIT 1) AS port_mode,
         (SELECT quantile_cont(fare_raw, 0.5) FROM people) AS fare_median,
         (SELECT quantile_cont(fare_raw, 0.5) FROM people WHERE {SQL_SUB_POP}) AS fare_median_sub,
         (SELECT avg(age_raw) FROM people) AS age_mean)
SELECT person_id, coalesce(port_raw, s.port_mode) AS port_raw_filled,
       round(coalesce(fare_raw, s.fare_median), {A}) AS fare_raw_filled,
       round(coalesce(fare_raw, s.fare_median_sub), {A}) AS fare_raw_sub_filled,
       round(coalesce(age_raw, s.age_mean), {Z}) AS age_raw_filled,
       coalesce(port_raw, 'UNKNOWN') AS port_const
FROM people, s
""")


def q_zscore_fare(spark, sf):
    p = materialize(people(spark, sf))
    med = fit_fill(p, {"fare_raw": "median"}).values["fare_raw"]
    filled = p.withColumn("fare", F.coalesce(F.col("fare_raw"), F.lit(med)))
    train = F.col("is_test") == 0
    # SCL1, SCL2 and the raw-column fit in one pass
    got = stats.fit_many(filled, {"ma": ("mean", "fare", None), "sa": ("std_pop", "fare", None),
                                  "mt": ("mean", "fare", train), "st": ("std_pop", "fare", train),
                                  "mr": ("mean", "fare_raw", train), "sr": ("std_pop", "fare_raw", train)})
    r = {k: round(v, A) for k, v in got.items()}
    z_all = ZScoreModel({"fare": (r["ma"], r["sa"])})
    z_train = ZScoreModel({"fare": (r["mt"], r["st"])})
    z_raw = ZScoreModel({"fare_raw": (r["mr"], r["sr"])})
    raw = fill_with_mean(filled.withColumn("fare_z_train_filled", z_raw.expr("fare_raw")), ["fare_z_train_filled"])
    return raw.select("person_id", F.round(z_all.expr("fare"), Z).alias("fare_z_all"),
                      F.round(z_train.expr("fare"), Z).alias("fare_z_train"),
                      F.round("fare_z_train_filled", Z).alias("fare_z_train_filled"))


SQL_ZSCORE_FARE = with_people(f"""
WITH med AS (SELECT quantile_cont(fare_raw, 0.5) AS m FROM people),
f AS (SELECT p.person_id, p.is_test, p.fare_raw, coalesce(p.fare_raw, med.m) AS fare FROM people p, med),
sa AS (SELECT round(avg(fare), {A}) AS m, round(stddev_pop(fare), {A}) AS s FROM f),
st AS (SELECT round(avg(fare), {A}) AS m, round(stddev_pop(fare), {A}) AS s FROM f WHERE is_test = 0),
sr AS (SELECT round(avg(fare_raw), {A}) AS m, round(stddev_pop(fare_raw), {A}) AS s FROM f WHERE is_test = 0),
zr AS (SELECT f.*, (f.fare_raw - sr.m) / sr.s AS zraw FROM f, sr),
zm AS (SELECT avg(zraw) AS m FROM zr)
SELECT zr.person_id, round((zr.fare - sa.m) / sa.s, {Z}) AS fare_z_all,
       round((zr.fare - st.m) / st.s, {Z}) AS fare_z_train,
       round(coalesce(zr.zraw, zm.m), {Z}) AS fare_z_train_filled
FROM zr, sa, st, zm
""")

_PORTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def q_one_hot(spark, sf):
    p = people(spark, sf).select("person_id", "port_raw", "cabin_raw")
    model = fit_one_hot(p, ["port_raw", "cabin_raw"])
    return model.apply(p)


SQL_ONE_HOT = with_people("SELECT person_id, " + ", ".join(
    [f"CASE WHEN port_raw = '{v}' THEN 1 ELSE 0 END AS \"port_raw_{v}\"" for v in _PORTS]
    + [f"CASE WHEN cabin_raw = '{v}' THEN 1 ELSE 0 END AS \"cabin_raw_{v}\"" for v in _SEGMENTS]) + " FROM people")


def q_category_lists(spark, sf):
    p = people(spark, sf)
    cols = ["port_raw", "cabin_raw", "sex_raw"]
    return (p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                         for c in cols])).alias("s"))
            .select("s.*").filter(F.col("value").isNotNull()).distinct())


SQL_CATEGORY_LISTS = with_people("""
SELECT DISTINCT 'port_raw' AS "column", port_raw AS value FROM people WHERE port_raw IS NOT NULL
UNION SELECT DISTINCT 'cabin_raw', cabin_raw FROM people WHERE cabin_raw IS NOT NULL
UNION SELECT DISTINCT 'sex_raw', sex_raw FROM people WHERE sex_raw IS NOT NULL
""")


def q_summary_fare_age(spark, sf):
    p = materialize(people(spark, sf).select("fare_raw", "age_raw"))
    s = stats.summary_exact(p, ["fare_raw", "age_raw"])
    return s.select("column", *[F.round(c, A).alias(c) for c in s.columns if c != "column"])


SQL_SUMMARY_FARE_AGE = with_people(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(CAST(count({c}) AS DOUBLE), {A}) AS count, round(avg({c}), {A}) AS mean,
       round(stddev_samp({c}), {A}) AS std, round(CAST(min({c}) AS DOUBLE), {A}) AS min,
       round(quantile_cont({c}, 0.25), {A}) AS q25, round(quantile_cont({c}, 0.5), {A}) AS q50,
       round(quantile_cont({c}, 0.75), {A}) AS q75, round(CAST(max({c}) AS DOUBLE), {A}) AS max
FROM people""" for c in ("fare_raw", "age_raw")))


# --- leave-one-out group label ---------------------------------------------------------------------

def q_loo_pass1(spark, sf):
    p = people(spark, sf).select("person_id", "family_key", "ticket_group_key", "label")
    return groups.loo_group_label(p, ["family_key", "ticket_group_key"], "label", "group_label", row_id="person_id") \
        .select("person_id", "group_label")


def _sql_loo(keys: list[str], prev: str | None, src: str, alias: str) -> str:
    on = " AND ".join(f"s.{k} = g.{k}" for k in keys)
    o1 = "g.n1 - CASE WHEN s.label = 1 THEN 1 ELSE 0 END"
    o0 = "g.n0 - CASE WHEN s.label = 0 THEN 1 ELSE 0 END"
    fallback = "0.5" if prev is None else f"s.{prev}"
    head = "" if prev is None else f"WHEN s.{prev} >= 1 THEN s.{prev} "
    return f"""(SELECT s.*, CAST(CASE {head}WHEN {o1} > 0 THEN 1.0 WHEN {o0} > 0 THEN 0.0 ELSE {fallback} END AS DOUBLE)
              AS {alias}
       FROM {src} s LEFT JOIN (SELECT {", ".join(keys)}, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n1,
                                      sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n0
                               FROM {src} WHERE {" AND ".join(f"{k} IS NOT NULL" for k in keys)}
                               GROUP BY {", ".join(keys)}) g ON {on})"""


SQL_LOO_PASS1 = with_people(
    f"SELECT person_id, group_label FROM {_sql_loo(['family_key', 'ticket_group_key'], None, 'people', 'group_label')}")


def _loo_two(spark, sf):
    p = people(spark, sf).select("person_id", "family_key", "ticket_group_key", "label",
                                 text.first_digits("name_raw").alias("ticket"))
    first = groups.loo_group_label(p, ["family_key", "ticket_group_key"], "label", "pass1", row_id="person_id")
    return groups.loo_group_label(first, ["ticket"], "label", "group_label", prev="pass1", row_id="person_id")


def q_loo_two_pass(spark, sf):
    return _loo_two(spark, sf).select("person_id", "pass1", "group_label")


_SQL_T = f"(SELECT person_id, family_key, ticket_group_key, label, {SQL_DIGITS} AS ticket FROM people)"
_SQL_P1 = _sql_loo(["family_key", "ticket_group_key"], None, "t", "pass1")
SQL_LOO_TWO_PASS = with_people(f"""
WITH t AS {_SQL_T}, p1 AS {_SQL_P1}
SELECT person_id, pass1, group_label FROM {_sql_loo(['ticket'], 'pass1', 'p1', 'group_label')}
""")


def q_loo_distribution(spark, sf):
    two = _loo_two(spark, sf)
    a = two.groupBy(F.col("pass1").alias("group_label")).agg(F.count(F.lit(1)).alias("n")).withColumn("pass", F.lit(1))
    b = two.groupBy("group_label").agg(F.count(F.lit(1)).alias("n")).withColumn("pass", F.lit(2))
    return a.unionByName(b)


SQL_LOO_DISTRIBUTION = with_people(f"""
WITH t AS {_SQL_T}, p1 AS {_SQL_P1}, p2 AS {_sql_loo(['ticket'], 'pass1', 'p1', 'group_label')}
SELECT pass1 AS group_label, count(*) AS n, 1 AS pass FROM p2 GROUP BY pass1
UNION ALL SELECT group_label, count(*) AS n, 2 AS pass FROM p2 GROUP BY group_label
""")


def q_loo_fold_aware(spark, sf):
    """Q7 variant: labels of hold-out rows (SPL1, seed 42) do not count in the group label."""
    p = split.holdout_flag(people(spark, sf).select("person_id", "family_key", "ticket_group_key", "label"),
                           "person_id", 0.2, 42)
    out = groups.loo_group_label(p, ["family_key", "ticket_group_key"], "label", "group_label",
                                 visible=F.col("is_holdout") == 0, row_id="person_id")
    return out.select("person_id", "is_holdout", "group_label")


_SQL_VIS = "(s.is_holdout = 0)"
SQL_LOO_FOLD_AWARE = with_people(f"""
WITH h AS (SELECT person_id, family_key, ticket_group_key, label,
                  CAST({_sql_hash_hex('person_id', 42)} < '33333333' AS INTEGER) AS is_holdout FROM people),
g AS (SELECT family_key, ticket_group_key,
             sum(CASE WHEN label = 1 AND is_holdout = 0 THEN 1 ELSE 0 END) AS n1,
             sum(CASE WHEN label = 0 AND is_holdout = 0 THEN 1 ELSE 0 END) AS n0
      FROM h WHERE family_key IS NOT NULL AND ticket_group_key IS NOT NULL GROUP BY family_key, ticket_group_key)
SELECT s.person_id, s.is_holdout,
       CAST(CASE WHEN g.n1 - CASE WHEN s.label = 1 AND {_SQL_VIS} THEN 1 ELSE 0 END > 0 THEN 1.0
                 WHEN g.n0 - CASE WHEN s.label = 0 AND {_SQL_VIS} THEN 1 ELSE 0 END > 0 THEN 0.0
                 ELSE 0.5 END AS DOUBLE) AS group_label
FROM h s LEFT JOIN g ON s.family_key = g.family_key AND s.ticket_group_key = g.ticket_group_key
""")


# --- family rules -----------------------------------------------------------------------------------

def _with_surname(spark, sf):
    return people(spark, sf).withColumn("surname", text.before_first("name_raw", ",", trim=True))


def _lists(p):
    return rules.rule_lists(p, "surname", "label", "sex_raw", "age_raw")


def q_family_rule_lists(spark, sf):
    return _lists(_with_surname(spark, sf))


def _sql_fam(women: int = 0, men: int = 1) -> str:
    return f"""
s AS (SELECT *, trim(split_part(name_raw, ',', 1)) AS surname FROM people),
f AS (SELECT s.*, count(*) OVER (PARTITION BY surname) AS fam FROM s WHERE surname IS NOT NULL),
m AS (SELECT * FROM f WHERE fam >= 2 AND label IN (0, 1)),
r AS (SELECT surname, 0 AS rule_index, CAST(0.0 AS DOUBLE) AS assign FROM m
        WHERE age_raw <= 16 OR sex_raw = 'female' GROUP BY surname HAVING avg(label) = {women}
      UNION ALL
      SELECT surname, 1 AS rule_index, CAST(1.0 AS DOUBLE) AS assign FROM m
        WHERE age_raw > 16 AND sex_raw = 'male' GROUP BY surname HAVING avg(label) = {men}),
b AS (SELECT surname, arg_max(assign, rule_index) AS rule FROM r GROUP BY surname)"""


_SQL_FAM = _sql_fam()
SQL_FAMILY_RULE_LISTS = with_people(f"WITH {_SQL_FAM}\nSELECT surname, rule_index, assign FROM r")


def q_rule_filled_labels(spark, sf):
    p = _with_surname(spark, sf)
    return rules.fill_by_rules(p, _lists(p), "surname", "label", out="label_filled", row_id="person_id").select("person_id", "label_filled")


SQL_RULE_FILLED_LABELS = with_people(f"""WITH {_SQL_FAM}
SELECT person_id, CASE WHEN label IS NULL AND b.rule IS NOT NULL THEN b.rule ELSE label END AS label_filled
FROM s LEFT JOIN b USING (surname)""")

def q_rule_rewrites(spark, sf):
    p = _with_surname(spark, sf).withColumns({
        "sex": codes.lookup("sex_raw", SEX_CODES), "age": F.col("age_raw"),
        "title": codes.lookup(codes.collapse(text.honorific("name_raw"), RARE_TITLES), TITLE_CODES, TITLE_DEFAULT)})
    out = rules.rewrite_by_rules(p, _lists(p), "surname", "label", RULE_REWRITES, row_id="person_id")
    return out.select("person_id", "sex", "age", "title")


SQL_RULE_REWRITES = with_people(f"""WITH {_SQL_FAM},
x AS (SELECT s.*, {_sql_case('sex_raw', SEX_CODES)} AS sex0, age_raw AS age0,
             coalesce({_sql_case(f"CASE WHEN {SQL_TITLE} IN ({_sql_list(RARE_TITLES)}) THEN 'Rare' ELSE {SQL_TITLE} END",
                                 TITLE_CODES)}, {TITLE_DEFAULT}) AS title0 FROM s)
SELECT person_id,
       CASE WHEN label IS NULL AND b.rule = 0 THEN 0 WHEN label IS NULL AND b.rule = 1 THEN 1 ELSE sex0 END AS sex,
       CASE WHEN label IS NULL AND b.rule = 0 THEN 28.0::DOUBLE WHEN label IS NULL AND b.rule = 1 THEN 5.0::DOUBLE
            ELSE age0 END AS age,
       CASE WHEN label IS NULL AND b.rule = 0 THEN 0 WHEN label IS NULL AND b.rule = 1 THEN 1 ELSE title0 END AS title
FROM x LEFT JOIN b USING (surname)""")


def q_override_table(spark, sf):
    p = _with_surname(spark, sf)
    return rules.override_table(p, _lists(p), "person_id", "surname")


SQL_OVERRIDE_TABLE = with_people(f"""WITH {_SQL_FAM}
SELECT person_id, coalesce(CAST(b.rule AS INTEGER), -1) AS rule FROM s LEFT JOIN b USING (surname)""")


SQL_MEMBER_FLAGS = with_people(f"""WITH {_SQL_FAM}
SELECT person_id, coalesce(surname IN (SELECT surname FROM r), false) AS listed FROM s""")


def q_override_table_copy_sense(spark, sf):
    """RUL4 in the sense of the exported table: all-1 women and children -> 0, all-0 men -> 1."""
    p = _with_surname(spark, sf)
    lists = rules.rule_lists(p, "surname", "label", "sex_raw", "age_raw", rules.COPY_RULES)
    return rules.override_table(p, lists, "person_id", "surname")


SQL_OVERRIDE_TABLE_COPY_SENSE = with_people(f"""WITH {_sql_fam(women=1, men=0)}
SELECT person_id, coalesce(CAST(b.rule AS INTEGER), -1) AS rule FROM s LEFT JOIN b USING (surname)""")


def q_override_predictions(spark, sf):
    p = _with_surname(spark, sf)
    ov = rules.override_table(p, _lists(p), "person_id", "surname")
    pred = p.select("person_id", (F.col("n_relatives") >= 4).cast("int").alias("prediction"))
    return rules.apply_overrides(pred, ov, "person_id")


SQL_OVERRIDE_PREDICTIONS = with_people(f"""WITH {_SQL_FAM},
o AS (SELECT person_id, coalesce(CAST(b.rule AS INTEGER), -1) AS rule FROM s LEFT JOIN b USING (surname))
SELECT s.person_id, coalesce(nullif(o.rule, -1), CAST(s.n_relatives >= 4 AS INTEGER)) AS prediction
FROM s LEFT JOIN o ON s.person_id = o.person_id""")


def q_listed_members(spark, sf):
    p = _with_surname(spark, sf)
    listed = _lists(p).filter(F.col("rule_index") == 0)
    return p.join(listed.select("surname"), "surname", "left_semi").select("person_id", "surname")


SQL_LISTED_MEMBERS = with_people(f"""WITH {_SQL_FAM}
SELECT person_id, surname FROM s WHERE surname IN (SELECT surname FROM r WHERE rule_index = 0)""")


# --- splits and numbering --------------------------------------------------------------------------

def q_holdout_split(spark, sf):
    return split.holdout_flag(people(spark, sf).select("person_id"), "person_id", 0.2, 42)


SQL_HOLDOUT_SPLIT = with_people(
    f"SELECT person_id, CAST({_sql_hash_hex('person_id', 42)} < '33333333' AS INTEGER) AS is_holdout FROM people")


def q_kfold_assign(spark, sf):
    return split.kfold(people(spark, sf).select("person_id"), "person_id", 3, 1)


SQL_KFOLD_ASSIGN = with_people(
    f"SELECT person_id, CAST({_sql_hash_int('person_id', 1)} % 3 AS INTEGER) AS fold FROM people")


def _strat(spark, sf, k):
    p = people(spark, sf).filter(F.col("is_test") == 0).select("person_id", "label")
    return split.stratified_kfold(p, "person_id", "label", k, 0)


def _sql_strat(k: int) -> str:
    return with_people(f"""
SELECT person_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY {_sql_hash_int('person_id', 0)}, person_id) - 1) % {k}
            AS INTEGER) AS fold
FROM people WHERE is_test = 0""")


def q_stratified_folds(spark, sf):
    return _strat(spark, sf, 5)


def q_stratified_folds_32(spark, sf):
    return _strat(spark, sf, 32)


def q_submission_row_index(spark, sf):
    p = people(spark, sf).filter(F.col("is_test") == 1).select("person_id")
    return io.with_row_index(p, "person_id")


SQL_SUBMISSION_ROW_INDEX = with_people(
    "SELECT row_number() OVER (ORDER BY person_id) - 1 AS row_index, person_id FROM people WHERE is_test = 1")


def q_family_row_numbers(spark, sf):
    p = people(spark, sf).select("person_id", "family_key")
    return row_number_within(p, ["person_id"], ["family_key"], name="member_index")


SQL_FAMILY_ROW_NUMBERS = with_people(
    "SELECT person_id, family_key, row_number() OVER (PARTITION BY family_key ORDER BY person_id) - 1 AS member_index "
    "FROM people")


# --- selection and augmentation ----------------------------------------------------------------------

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_anova_f_lineitem(spark, sf):
    li = read_table(spark, sf, "lineitem", LINE_FEATURES + ["l_returnflag"])
    ranked = select.rank_features(select.anova_f(li, LINE_FEATURES, "l_returnflag"), 2)
    return ranked.select("feature", F.round("f_value", A).alias("f_value"), "rank", "selected")


_SQL_PC = ", ".join(f"avg({f}) AS m{i}, var_pop({f}) AS v{i}" for i, f in enumerate(LINE_FEATURES))
_SQL_LONG = " UNION ALL ".join(f"SELECT '{f}' AS feature, n, m{i} AS mean, v{i} AS var FROM pc"
                               for i, f in enumerate(LINE_FEATURES))
SQL_ANOVA_F_LINEITEM = f"""
WITH pc AS (SELECT l_returnflag, count(*) AS n, {_SQL_PC} FROM lineitem WHERE l_returnflag IS NOT NULL
            GROUP BY l_returnflag),
lg AS ({_SQL_LONG}),
tot AS (SELECT feature, sum(n) AS nn, sum(n * mean) / sum(n) AS grand, count(*) AS c, sum(n * var) AS ssw
        FROM lg GROUP BY feature),
fv AS (SELECT lg.feature, (sum(lg.n * (lg.mean - tot.grand) * (lg.mean - tot.grand)) / (tot.c - 1))
                          / (tot.ssw / (tot.nn - tot.c)) AS f_value
       FROM lg JOIN tot ON lg.feature = tot.feature GROUP BY lg.feature, tot.c, tot.ssw, tot.nn),
rk AS (SELECT feature, f_value, row_number() OVER (ORDER BY f_value DESC NULLS LAST, feature) AS r FROM fv)
SELECT feature, round(f_value, {A}) AS f_value, CAST(r AS INTEGER) AS rank, CAST(r <= 2 AS INTEGER) AS selected FROM rk
"""

MIX_FEATURES = ["n_relatives", "class_raw", "ticket_group_key"]


def q_mixup_people(spark, sf):
    p = people(spark, sf).filter(F.col("is_test") == 0).select(
        "person_id", *[F.col(c).cast("double").alias(c) for c in MIX_FEATURES], "label")
    m = mixup(p, "person_id", MIX_FEATURES, "label", **MIXUP)
    out = m.select("person_id", *[F.round(c, Z).alias(c) for c in MIX_FEATURES + ["label"]],
                   "partner_key", "is_synthetic")
    # SNK6: originals and mixed rows, features and soft label together, as one parquet table
    path = scratch_path(spark, "augmented")
    io.write_table(out, path)
    return io.read_prepared(spark, path)


_SQL_MIX_SEL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MIX_FEATURES)
_SQL_MIX_VAL = ", ".join(f"round(CAST(0.1 AS DOUBLE) * h.{c} + CAST(0.9 AS DOUBLE) * q.{c}, {Z}) AS {c}"
                         for c in MIX_FEATURES + ["label"])
SQL_MIXUP_PEOPLE = with_people(f"""
WITH b AS (SELECT person_id, {_SQL_MIX_SEL}, label FROM people WHERE is_test = 0),
nb AS (SELECT *, row_number() OVER (ORDER BY person_id) - 1 AS rn FROM b),
cnt AS (SELECT count(*) AS n FROM b),
h AS (SELECT nb.*, {_sql_hash_int('person_id', 622)} % cnt.n AS prn FROM nb, cnt WHERE rn < 350)
SELECT person_id, {", ".join(f"round({c}, {Z}) AS {c}" for c in MIX_FEATURES + ['label'])},
       CAST(NULL AS BIGINT) AS partner_key, 0 AS is_synthetic FROM b
UNION ALL
SELECT h.person_id, {_SQL_MIX_VAL}, q.person_id AS partner_key, 1 AS is_synthetic
FROM h JOIN nb q ON q.rn = h.prn
""")


# --- histories ------------------------------------------------------------------------------------------

def _events(spark, sf):
    return read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])


def q_patience_events(spark, sf):
    h = history.patience(_events(spark, sf), "user_id", ["ts", "event_id"], "value", patience=15)
    return h.select("event_id", "user_id", "step", "best", "is_ok", "counter", "is_stop")


_SQL_PATIENCE = """
e AS (SELECT event_id, user_id, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
             min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before,
             min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
      FROM events),
o AS (SELECT *, (best_before IS NULL OR value <= best_before) AS is_ok FROM e),
c AS (SELECT *, step - max(CASE WHEN is_ok THEN step ELSE -1 END)
                  OVER (PARTITION BY user_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter
      FROM o),
s AS (SELECT user_id, min(step) AS stop_step FROM c WHERE counter >= 15 GROUP BY user_id),
h AS (SELECT c.*, coalesce(c.step = s.stop_step, false) AS is_stop FROM c LEFT JOIN s USING (user_id))"""
SQL_PATIENCE_EVENTS = f"WITH {_SQL_PATIENCE}\nSELECT event_id, user_id, step, best, is_ok, counter, is_stop FROM h"


def q_stop_points_events(spark, sf):
    h = history.patience(_events(spark, sf), "user_id", ["ts", "event_id"], "value", patience=15)
    return history.stop_points(h, "user_id")


SQL_STOP_POINTS_EVENTS = f"""WITH {_SQL_PATIENCE}
SELECT user_id, min(CASE WHEN is_stop THEN step END) AS stop_step, min(best) AS best_loss, count(*) AS n_steps
FROM h GROUP BY user_id"""


def q_tail_mean_events(spark, sf):
    return history.tail_mean(_events(spark, sf), "user_id", ["ts", "event_id"], "value", n=10, digits=3)


SQL_TAIL_MEAN_EVENTS = """
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
           FROM events)
SELECT user_id, round(avg(value), 3) AS tail_mean, count(*) AS n_points FROM r WHERE rn <= 10 GROUP BY user_id
"""


# --- evaluation tables --------------------------------------------------------------------------------------

def _quality(spark, sf):
    lab = read_table(spark, sf, "labels", ["doc_id", "quality"])
    doc = read_table(spark, sf, "documents", ["doc_id", "n_chars"])
    return lab.join(doc, "doc_id").select("doc_id", F.col("quality").alias("y"),
                                          (F.col("n_chars") > 1500).cast("int").alias("p"))


_SQL_Q = ("q AS (SELECT l.doc_id, l.quality AS y, CAST(d.n_chars > 1500 AS INTEGER) AS p "
          "FROM labels l JOIN documents d ON l.doc_id = d.doc_id),\n"
          "c AS (SELECT count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp, "
          "count_if(y = 1 AND p = 0) AS fn, count_if(y = 0 AND p = 0) AS tn, count(*) AS n FROM q)")


def _sql_ratio(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


def q_quality_metrics(spark, sf):
    m = metrics.binary_metrics(_quality(spark, sf), "y", "p")
    return m.select("n", *[F.round(c, Z).alias(c) for c in m.columns if c != "n"])


SQL_QUALITY_METRICS = f"""WITH {_SQL_Q}
SELECT n, round({_sql_ratio('tp + tn', 'n')}, {Z}) AS accuracy, round({_sql_ratio('tp', 'tp + fp')}, {Z}) AS precision,
       round({_sql_ratio('tp', 'tp + fn')}, {Z}) AS recall, round({_sql_ratio('2 * tp', '2 * tp + fp + fn')}, {Z}) AS f1,
       round(({_sql_ratio('tp', 'tp + fn')} + {_sql_ratio('tn', 'tn + fp')}) / 2, {Z}) AS auc_hard,
       round({_sql_ratio('tp + fp', 'n')}, {Z}) AS share_pred_ones
FROM c"""


def q_quality_confusion(spark, sf):
    return metrics.confusion_matrix(_quality(spark, sf), "y", "p")


SQL_QUALITY_CONFUSION = f"""WITH {_SQL_Q}
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c"""


def q_quality_class_report(spark, sf):
    r = metrics.classification_report(_quality(spark, sf), "y", "p")
    return r.select("class", *[F.round(c, Z).alias(c) for c in ("precision", "recall", "f1", "support")])


_P1, _R1 = _sql_ratio("tp", "tp + fp"), _sql_ratio("tp", "tp + fn")
_P0, _R0 = _sql_ratio("tn", "tn + fn"), _sql_ratio("tn", "tn + fp")
_F1, _F0 = _sql_ratio("2 * tp", "2 * tp + fp + fn"), _sql_ratio("2 * tn", "2 * tn + fn + fp")
SQL_QUALITY_CLASS_REPORT = f"""WITH {_SQL_Q},
r AS (
  SELECT '0' AS class, {_P0} AS precision, {_R0} AS recall, {_F0} AS f1, CAST(tn + fp AS DOUBLE) AS support FROM c
  UNION ALL SELECT '1', {_P1}, {_R1}, {_F1}, CAST(tp + fn AS DOUBLE) FROM c
  UNION ALL SELECT 'accuracy', NULL, NULL, {_sql_ratio('tp + tn', 'n')}, CAST(n AS DOUBLE) FROM c
  UNION ALL SELECT 'macro avg', ({_P0} + {_P1}) / 2, ({_R0} + {_R1}) / 2, ({_F0} + {_F1}) / 2, CAST(n AS DOUBLE) FROM c
  UNION ALL SELECT 'weighted avg',
     {_sql_ratio(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', 'n')},
     {_sql_ratio(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', 'n')},
     {_sql_ratio(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', 'n')}, CAST(n AS DOUBLE) FROM c)
SELECT class, round(precision, {Z}) AS precision, round(recall, {Z}) AS recall, round(f1, {Z}) AS f1,
       round(support, {Z}) AS support FROM r"""


# --- sinks -------------------------------------------------------------------------------------------------

def q_io_roundtrip(spark, sf):
    """Write a submission-shaped table as headed CSV to the shared scratch folder, read it back
    with an explicit schema (no inference), and return what was read."""
    p = people(spark, sf).filter(F.col("is_test") == 1)
    sub = io.submission(p.withColumn("prediction", (F.col("n_relatives") >= 4).cast("int")), "person_id",
                        "prediction", "label")
    path = scratch_path(spark, f"submission-{uuid.uuid4().hex[:8]}")
    io.write_table(sub, path, fmt="csv")
    return io.read_csv_table(spark, path, T.StructType([T.StructField("person_id", T.LongType()),
                                                        T.StructField("label", T.IntegerType())]))


SQL_IO_ROUNDTRIP = with_people(
    "SELECT person_id, CAST(n_relatives >= 4 AS INTEGER) AS label FROM people WHERE is_test = 1")


def q_label_sidecar(spark, sf):
    """SNK4: the label of the labelled rows as its own (key, label) table, written and read back."""
    path = scratch_path(spark, "label-sidecar")
    io.write_table(io.label_sidecar(people(spark, sf).filter(F.col("is_test") == 0), "person_id", "label"), path)
    return spark.read.parquet(path)


SQL_LABEL_SIDECAR = with_people("SELECT person_id, label FROM people WHERE is_test = 0")


def q_override_roundtrip(spark, sf):
    """SRC3 + SNK1 + JN4: the rule-override table is written to the shared folder, read back
    with its schema and applied to a rule-of-thumb prediction by key."""
    p = _with_surname(spark, sf)
    path = scratch_path(spark, "override")
    io.write_table(rules.override_table(p, _lists(p), "person_id", "surname"), path)
    ov = io.read_override_table(spark, path)
    pred = p.filter(F.col("is_test") == 1).select("person_id", (F.col("n_relatives") >= 4).cast("int").alias("prediction"))
    return rules.apply_overrides(pred, ov, "person_id")


SQL_OVERRIDE_ROUNDTRIP = with_people(f"""WITH {_SQL_FAM},
o AS (SELECT person_id, coalesce(CAST(b.rule AS INTEGER), -1) AS rule FROM s LEFT JOIN b USING (surname))
SELECT s.person_id, coalesce(nullif(o.rule, -1), CAST(s.n_relatives >= 4 AS INTEGER)) AS prediction
FROM s LEFT JOIN o ON s.person_id = o.person_id WHERE s.is_test = 1""")


# --- the full preparation (flagship) -------------------------------------------------------------------

AGE_DIGITS = 4   # digits of a least-squares fill that two engines' summation orders agree on


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j, x in enumerate(m[0]):
        minor = _det([[v for k, v in enumerate(r) if k != j] for r in m[1:]])
        terms.append(f"{'-' if j % 2 else '+'} ({x}) * ({minor})")
    return "0 " + " ".join(terms)


def sql_least_squares(src: str, y: str, xs: list[str], where: str = "true") -> tuple[str, str]:
    """(SQL of a one-row table of sums, prediction expression over it): least squares by Cramer's rule
    on population covariances."""
    k = range(len(xs))
    cov = [[f"c{min(i, j)}{max(i, j)}" for j in k] for i in k]
    sums = [f"avg({y}) AS my", *(f"avg({x}) AS m{i}" for i, x in enumerate(xs)),
            *(f"covar_pop({xs[i]}, {xs[j]}) AS c{i}{j}" for i in k for j in k if i <= j),
            *(f"covar_pop({xs[i]}, {y}) AS cy{i}" for i in k)]
    table = f"(SELECT {', '.join(sums)} FROM {src} WHERE {y} IS NOT NULL AND {where})"
    pred = "my"
    for i, x in enumerate(xs):
        swapped = [[f"cy{r}" if j == i else cov[r][j] for j in k] for r in k]
        pred += f" + (({_det(swapped)}) / ({_det(cov)})) * ({x} - m{i})"
    return table, pred


def q_prepare_features(spark, sf):
    out = prepare(people(spark, sf))
    return out.withColumn("age", F.round("age", AGE_DIGITS))


def _sql_prepare(extra: str = "") -> str:
    reg, pred = sql_least_squares("a0", "age0", ["class", "port", "n_relatives"])
    t = f"CASE WHEN {SQL_TITLE} IN ({_sql_list(RARE_TITLES)}) THEN 'Rare' ELSE {SQL_TITLE} END"
    port_codes = PrepareConfig().port_codes
    dummies = (["CAST(CASE WHEN title = 0 THEN 1 ELSE 0 END AS DOUBLE) AS title_0"]
               + [f"CAST(CASE WHEN class = {v} THEN 1 ELSE 0 END AS DOUBLE) AS class_{v}" for v in (1, 2, 3)]
               + [f"CAST(CASE WHEN family_survival = {v} THEN 1 ELSE 0 END AS DOUBLE) AS \"family_survival_{v}\""
                  for v in ("0.0", "0.5", "1.0")]
               + [f"CAST(CASE WHEN cabin = {v} THEN 1 ELSE 0 END AS DOUBLE) AS cabin_{v}" for v in (0, 1, 5, 8)])
    return with_people(f"""
WITH r AS (
  SELECT p.*, {_sql_case("coalesce(substr(cabin_raw, 1, 1), 'M')", CABIN_CODES)} AS cabin,
         {SQL_DIGITS} AS ticket0, {_sql_case('sex_raw', SEX_CODES)} AS sex,
         coalesce({_sql_case(t, TITLE_CODES)}, {TITLE_DEFAULT}) AS title, class_raw AS class
  FROM people p),
st1 AS (SELECT (SELECT port_raw FROM r WHERE port_raw IS NOT NULL GROUP BY port_raw
                ORDER BY count(*) DESC, port_raw LIMIT 1) AS port_mode,
               (SELECT ticket0 FROM r WHERE ticket0 IS NOT NULL GROUP BY ticket0
                ORDER BY count(*) DESC, ticket0 LIMIT 1) AS ticket_mode,
               (SELECT quantile_cont(fare_raw, 0.5) FROM r) AS fare_median),
f AS (SELECT r.*, coalesce(r.ticket0, st1.ticket_mode) AS ticket_digits,
             CAST(coalesce(r.fare_raw, st1.fare_median) AS DOUBLE) AS fare,
             {_sql_case('coalesce(r.port_raw, st1.port_mode)', port_codes)} AS port
      FROM r, st1),
l1 AS {_sql_loo(['family_key', 'ticket_group_key'], None, 'f', 'pass1')},
l2 AS {_sql_loo(['ticket_digits'], 'pass1', 'l1', 'family_survival')},
a0 AS (SELECT l2.*, n_relatives + 1 AS family_size, CAST(age_raw AS DOUBLE) AS age0 FROM l2),
reg AS {reg},
a AS (SELECT a0.*, coalesce(age0, greatest(least({pred}, 80.0), 0.0)) AS age FROM a0, reg)
SELECT person_id, {", ".join(dummies)},
       CAST(sex AS DOUBLE) AS sex, CAST(n_relatives AS DOUBLE) AS n_relatives,
       CAST(family_size AS DOUBLE) AS family_size, CAST(is_test AS DOUBLE) AS is_test,
       {extra}round(age, {AGE_DIGITS}) AS age, label
FROM a""")


SQL_PREPARE_FEATURES = _sql_prepare()


def q_prepare_variant(spark, sf):
    """Snapshot options: port and family-size-bin dummies kept, ages and relatives scaled at the end
    by a scaler fitted on the labelled rows."""
    base = PrepareConfig()
    out = prepare(people(spark, sf), PrepareConfig(
        onehot=base.onehot + ("family_size_bin",), feature_prefixes=base.feature_prefixes + ("port_", "family_size_bin_"),
        scale_features=("age", "n_relatives")))
    return out.withColumns({c: F.round(c, AGE_DIGITS) for c in ("age", "n_relatives")})


def _sql_prepare_variant() -> str:
    bins = "CASE WHEN family_size = 1 THEN 0 WHEN family_size <= 4 THEN 1 WHEN family_size <= 7 THEN 2 ELSE 3 END"
    extra = "".join([f"CAST(CASE WHEN port = {v} THEN 1 ELSE 0 END AS DOUBLE) AS port_{v}, " for v in range(5)]
                    + [f"CAST(CASE WHEN {bins} = {v} THEN 1 ELSE 0 END AS DOUBLE) AS family_size_bin_{v}, "
                       for v in range(4)])
    plain = _sql_prepare(extra).replace(f"round(age, {AGE_DIGITS}) AS age", "age")
    return f"""WITH plain AS ({plain}),
sc AS (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(n_relatives) AS mr, stddev_pop(n_relatives) AS sr
       FROM plain WHERE is_test = 0)
SELECT plain.* REPLACE (round((age - ma) / sa, {AGE_DIGITS}) AS age,
                        round((n_relatives - mr) / sr, {AGE_DIGITS}) AS n_relatives)
FROM plain, sc"""


SQL_PREPARE_VARIANT = _sql_prepare_variant()


# --- the registry ----------------------------------------------------------------------------------------------

# --- discriminants, exact AUC, sparse one-hot ------------------------------------------------------------

_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _classified(spark, sf, kind):
    """Every line item, told returned or not by a discriminant fitted on all."""
    d = read_table(spark, sf, "lineitem", _LINE_KEYS + _LINE + ["l_returnflag"]).withColumn(
        "label", (F.col("l_returnflag") == "R").cast("double"))
    return (Discriminant(kind).fit(d, _LINE).transform(d)
            .select(*_LINE_KEYS, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")))


def q_naive_bayes_lines(spark, sf):
    """LDB2: Gaussian naive Bayes."""
    return _classified(spark, sf, "naive_bayes")


def q_nearest_centroid_lines(spark, sf):
    """LDB2: nearest centroid."""
    return _classified(spark, sf, "nearest_centroid")


def _sql_classified(score: str) -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_LINE))
    stats_ = ", ".join(f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}" for i in range(len(_LINE)))
    spread = ", ".join(f"var_pop(x{i})" for i in range(len(_LINE)))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                  {cols} FROM lineitem),
e AS (SELECT 1e-9 * greatest({spread}) AS e, count(*) AS n FROM d),
m AS (SELECT label AS class, count(*) AS k, {stats_} FROM d GROUP BY label),
s AS (SELECT d.*, class, {score} AS s FROM d, m, e)
SELECT l_orderkey, l_linenumber, label, CAST(arg_max(class, s - 1e-15 * class) AS INTEGER) AS prediction
FROM s GROUP BY rid, l_orderkey, l_linenumber, label"""


SQL_NAIVE_BAYES_LINES = _sql_classified("ln(k / n) - 0.5 * (" + " + ".join(
    f"ln(2 * pi() * (v{i} + e)) + (x{i} - m{i}) ** 2 / (v{i} + e)" for i in range(len(_LINE))) + ")")
SQL_NEAREST_CENTROID_LINES = _sql_classified("-(" + " + ".join(f"(x{i} - m{i}) ** 2" for i in range(len(_LINE))) + ")")


def q_nearest_orders(spark, sf):
    """LDB2: five nearest neighbours by price, day and priority; the hold-out orders get the status that most of
    their neighbours among all other orders have."""
    d = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]).select(
        "o_orderkey", F.col("o_orderstatus").alias("label"), (F.col("o_totalprice") / 1000).alias("price"),
        (F.datediff(F.col("o_orderdate"), F.lit("1992-01-01").cast("date")) / 10).alias("day"),
        (F.substring("o_orderpriority", 1, 1).cast("double") * 20).alias("priority"))
    d = split.holdout_flag(d, "o_orderkey", 0.2, 42)
    rest, held = d.where("is_holdout = 0"), d.where("is_holdout = 1")
    found = materialize(neighbours(rest, held, ["price", "day", "priority"], "o_orderkey", "o_orderkey", 5))
    ends = found.groupBy("o_orderkey").agg(F.min_by("neighbour", "rank").alias("nearest"), F.max("distance").alias("farthest"))
    said = vote(found, rest, "o_orderkey", "label", "o_orderkey")
    return (held.select("o_orderkey", "label").join(ends, "o_orderkey").join(said, "o_orderkey")
            .withColumn("farthest", F.round("farthest", A)))


SQL_NEAREST_ORDERS = f"""
WITH d AS (SELECT o_orderkey, o_orderstatus AS label, o_totalprice / 1000 AS price,
                  date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 10 AS day,
                  CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) * 20 AS priority,
                  {_sql_hash_hex('o_orderkey', 42)} < '33333333' AS held FROM orders),
near AS (SELECT h.o_orderkey, h.label, unnest(min({{'d': (h.price - r.price) * (h.price - r.price) + (h.day - r.day) * (h.day - r.day)
                  + (h.priority - r.priority) * (h.priority - r.priority), 'id': r.o_orderkey, 'label': r.label}}, 5)) AS x
         FROM d h, d r WHERE h.held AND NOT r.held GROUP BY h.o_orderkey, h.label),
votes AS (SELECT o_orderkey, x.label AS prediction, row_number() OVER (PARTITION BY o_orderkey ORDER BY count(*) DESC, x.label) AS r
          FROM near GROUP BY o_orderkey, x.label)
SELECT n.o_orderkey, any_value(n.label) AS label, arg_min(x.id, {{'d': x.d, 'id': x.id}}) AS nearest,
       round(max(x.d), {A}) AS farthest, any_value(v.prediction) AS prediction
FROM near n JOIN votes v ON n.o_orderkey = v.o_orderkey AND v.r = 1 GROUP BY n.o_orderkey"""


def q_ordered_target_means(spark, sf):
    """MOD5: ordered target statistics of the port (few values) and of the customer (many)."""
    p = people(spark, sf).select("person_id", "port_raw", "family_key", "label")
    p = ordered_target_mean(p, "port_raw", "label", "person_id", "port_mean", 1.0, 5)
    p = ordered_target_mean(p, "family_key", "label", "person_id", "family_mean", 1.0, 5)
    return p.select("person_id", F.round("port_mean", Z).alias("port_mean"), F.round("family_mean", Z).alias("family_mean"))


def _sql_ordered_mean(col: str) -> str:
    w = (f"(PARTITION BY {col} ORDER BY label IS NULL, {_sql_hash_int('person_id', 5)}, person_id "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return f"round((coalesce(sum(label) OVER {w}, 0) + prior) / (count(label) OVER {w} + 1), {Z})"


SQL_ORDERED_TARGET_MEANS = with_people(f"""
WITH q AS (SELECT *, (SELECT avg(label) FROM people) AS prior FROM people)
SELECT person_id, {_sql_ordered_mean('port_raw')} AS port_mean, {_sql_ordered_mean('family_key')} AS family_mean FROM q""")


def q_quality_auc(spark, sf):
    """EVL3 of scores: how well a document's length tells good from bad, and toxic from clean (many ties)."""
    d = (read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
         .join(read_table(spark, sf, "documents", ["doc_id", "n_chars"]), "doc_id"))
    tens = d.withColumn("tens", F.floor(F.col("n_chars") / 10))
    return (metrics.auc(d, "n_chars", "quality").select(F.lit("quality by n_chars").alias("name"), "*")
            .unionByName(metrics.auc(tens, "tens", "toxic").select(F.lit("toxic by tens").alias("name"), "*"))
            .select("name", F.round("auc", A).alias("auc"), "positives", "negatives"))


SQL_QUALITY_AUC = f"""
WITH d AS (SELECT quality, toxic, CAST(n_chars AS DOUBLE) AS s, floor(n_chars / 10) AS t FROM labels JOIN documents USING (doc_id)),
x AS (SELECT 'quality by n_chars' AS name, s, quality AS y FROM d UNION ALL SELECT 'toxic by tens', t, toxic FROM d),
r AS (SELECT name, y, avg(i) OVER (PARTITION BY name, s) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY s) AS i FROM x WHERE y IS NOT NULL AND s IS NOT NULL)),
c AS (SELECT name, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS n, sum(rank) FILTER (WHERE y = 1) AS ranks
      FROM r GROUP BY name)
SELECT name, round((ranks - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * n), {{A}}) AS auc, p AS positives, n AS negatives FROM c""".replace("{A}", str(A))


def q_one_hot_sparse(spark, sf):
    """AGG12 + ENC1 with any number of values: the customer of every order as a place in a sparse vector."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    index = value_index(orders, "o_custkey")
    out = sparse_one_hot(orders, "o_custkey", index, "customer", "o_orderkey")
    return out.select("o_orderkey", F.col("customer_idx").alias("idx"), F.lit(index.count()).alias("size"))


SQL_ONE_HOT_SPARSE = """
WITH v AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS idx FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT o_orderkey, idx, (SELECT count(*) FROM v) AS size FROM orders JOIN v USING (o_custkey)"""


SQL_QUERIES = {
    "naive_bayes_lines": (q_naive_bayes_lines, SQL_NAIVE_BAYES_LINES),
    "nearest_centroid_lines": (q_nearest_centroid_lines, SQL_NEAREST_CENTROID_LINES),
    "nearest_orders": (q_nearest_orders, SQL_NEAREST_ORDERS),
    "ordered_target_means": (q_ordered_target_means, SQL_ORDERED_TARGET_MEANS),
    "quality_auc": (q_quality_auc, SQL_QUALITY_AUC),
    "one_hot_sparse": (q_one_hot_sparse, SQL_ONE_HOT_SPARSE),
    "prepare_features": (q_prepare_features, SQL_PREPARE_FEATURES),
    "prepare_variant": (q_prepare_variant, SQL_PREPARE_VARIANT),
    "people_union": (q_people_union, SQL_PEOPLE_UNION),
    "source_profile": (q_source_profile, SQL_SOURCE_PROFILE),
    "cabin_codes": (q_cabin_codes, SQL_CABIN_CODES),
    "url_digits": (q_url_digits, SQL_URL_DIGITS),
    "doc_titles": (q_doc_titles, SQL_DOC_TITLES),
    "name_titles": (q_name_titles, SQL_NAME_TITLES),
    "vote_scores": (q_vote_scores, SQL_VOTE_SCORES),
    "member_flags": (q_member_flags, SQL_MEMBER_FLAGS),
    "part_name_head": (q_part_name_head, SQL_PART_NAME_HEAD),
    "conversation_head": (q_conversation_head, SQL_CONVERSATION_HEAD),
    "compound_filter": (q_compound_filter, SQL_COMPOUND_FILTER),
    "group_size_bins": (q_group_size_bins, SQL_GROUP_SIZE_BINS),
    "group_size_freq": (q_group_size_freq, SQL_GROUP_SIZE_FREQ),
    "fill_statistics": (q_fill_statistics, SQL_FILL_STATISTICS),
    "impute_fills": (q_impute_fills, SQL_IMPUTE_FILLS),
    "zscore_fare": (q_zscore_fare, SQL_ZSCORE_FARE),
    "one_hot": (q_one_hot, SQL_ONE_HOT),
    "category_lists": (q_category_lists, SQL_CATEGORY_LISTS),
    "summary_fare_age": (q_summary_fare_age, SQL_SUMMARY_FARE_AGE),
    "loo_pass1": (q_loo_pass1, SQL_LOO_PASS1),
    "loo_two_pass": (q_loo_two_pass, SQL_LOO_TWO_PASS),
    "loo_distribution": (q_loo_distribution, SQL_LOO_DISTRIBUTION),
    "loo_fold_aware": (q_loo_fold_aware, SQL_LOO_FOLD_AWARE),
    "family_rule_lists": (q_family_rule_lists, SQL_FAMILY_RULE_LISTS),
    "rule_filled_labels": (q_rule_filled_labels, SQL_RULE_FILLED_LABELS),
    "rule_rewrites": (q_rule_rewrites, SQL_RULE_REWRITES),
    "override_table": (q_override_table, SQL_OVERRIDE_TABLE),
    "override_table_copy_sense": (q_override_table_copy_sense, SQL_OVERRIDE_TABLE_COPY_SENSE),
    "override_predictions": (q_override_predictions, SQL_OVERRIDE_PREDICTIONS),
    "listed_members": (q_listed_members, SQL_LISTED_MEMBERS),
    "holdout_split": (q_holdout_split, SQL_HOLDOUT_SPLIT),
    "kfold_assign": (q_kfold_assign, SQL_KFOLD_ASSIGN),
    "stratified_folds": (q_stratified_folds, _sql_strat(5)),
    "stratified_folds_32": (q_stratified_folds_32, _sql_strat(32)),
    "submission_row_index": (q_submission_row_index, SQL_SUBMISSION_ROW_INDEX),
    "family_row_numbers": (q_family_row_numbers, SQL_FAMILY_ROW_NUMBERS),
    "anova_f_lineitem": (q_anova_f_lineitem, SQL_ANOVA_F_LINEITEM),
    "mixup_people": (q_mixup_people, SQL_MIXUP_PEOPLE),
    "patience_events": (q_patience_events, SQL_PATIENCE_EVENTS),
    "stop_points_events": (q_stop_points_events, SQL_STOP_POINTS_EVENTS),
    "tail_mean_events": (q_tail_mean_events, SQL_TAIL_MEAN_EVENTS),
    "quality_metrics": (q_quality_metrics, SQL_QUALITY_METRICS),
    "quality_confusion": (q_quality_confusion, SQL_QUALITY_CONFUSION),
    "quality_class_report": (q_quality_class_report, SQL_QUALITY_CLASS_REPORT),
    "io_roundtrip": (q_io_roundtrip, SQL_IO_ROUNDTRIP),
    "label_sidecar": (q_label_sidecar, SQL_LABEL_SIDECAR),
    "override_roundtrip": (q_override_roundtrip, SQL_OVERRIDE_ROUNDTRIP),
}
