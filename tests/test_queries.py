"""Registered queries against their SQL texts (DuckDB) on the small driver tables, plus the
entry contract and the sinks."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tabwright.sources.tables import TABLES
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    return v


def _rows(rows, order):
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SQL_NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    order = [dcols.index(c) for c in sdf.columns]
    assert _rows(srows, range(len(sdf.columns))) == _rows(drows, order)


def test_every_query_has_a_callable():
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    assert len(q) >= 60


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1500
    assert "person_id" in df.columns and "family_survival_0.5" in df.columns
    for r in rows:
        assert r["age"] is not None and 0.0 <= r["age"] <= 80.0


def test_model_query_rows(spark):
    df = E.queries()["model_random_forest"](spark, SF_SMALL)
    rows = df.collect()
    assert rows and set(df.columns) == {"person_id", "label", "score", "prediction"}
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_boost_patience_curve(spark):
    df = E.queries()["model_boost_rounds"](spark, SF_SMALL)
    rows = df.collect()
    stop = rows[0]["stop_round"]
    n_rounds = max(r["round"] for r in rows) + 1
    assert stop is None or n_rounds == stop + 1
    evals = sorted((r["round"], r["rmse"]) for r in rows if r["set"] == "eval")
    if stop is not None:
        best_before = min(v for _, v in evals[: stop - 14])
        assert all(v >= best_before for _, v in evals[stop - 14: stop + 1])


def test_submission_and_roundtrip(spark):
    sub = E.queries()["submission"](spark, SF_SMALL)
    assert sub.columns == ["person_id", "label"]
    rows = sub.collect()
    assert {r["label"] for r in rows} <= {0, 1}
    back = E.queries()["io_roundtrip"](spark, SF_SMALL)
    assert back.schema.simpleString() == "struct<person_id:bigint,label:int>"


def test_run_log(spark):
    rows = E.queries()["run_log"](spark, SF_SMALL).collect()
    keys = {r["key"]: r["value"] for r in rows}
    assert keys["num_trees"] == "26" and math.isclose(float(keys["threshold"]), 0.5)


def test_stream_submission_equals_batch(spark):
    q = E.queries()
    streamed = {(r["person_id"], r["label"]) for r in q["stream_submission"](spark, SF_SMALL).collect()}
    batch = {(r["person_id"], r["label"]) for r in q["submission"](spark, SF_SMALL).collect()}
    assert streamed == batch and len(batch) > 0


def test_model_queries_are_reproducible(spark):
    a = {(r["person_id"], r["prediction"], round(r["score"], 12)) for r in
         E.queries()["model_random_forest"](spark, SF_SMALL).collect()}
    b = {(r["person_id"], r["prediction"], round(r["score"], 12)) for r in
         E.queries()["model_random_forest"](spark, SF_SMALL).collect()}
    assert a == b
