"""Sources, sinks and the train/scoring union (SRC*, SNK*, UNI*).

Rows are identified by an explicit key column everywhere; nothing is glued by position.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.numbering import row_number_within


# --- sources -------------------------------------------------------------------------------

def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headed CSV with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a prepared feature table written by :func:`write_table`."""
    return spark.read.parquet(path)


OVERRIDE_SCHEMA = "person_id LONG, rule INT"


def read_override_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rule-override table: one row per key, rule in {-1, 0, 1} (-1 = no rule)."""
    if fmt == "csv":
        return read_csv_table(spark, path, OVERRIDE_SCHEMA)
    return spark.read.parquet(path)


# --- train / scoring union -----------------------------------------------------------------

def union_sources(train: DataFrame, scoring: DataFrame, flag_col: str = "is_test") -> DataFrame:
    """Stack labelled and scoring rows by column name; columns missing on one side (the label on
    the scoring side) become null; ``flag_col`` records the source (0 train, 1 scoring)."""
    return (train.withColumn(flag_col, F.lit(0))
            .unionByName(scoring.withColumn(flag_col, F.lit(1)), allowMissingColumns=True))


def stack(*frames: DataFrame) -> DataFrame:
    """Stack frames with the same columns (in any order)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def split_sources(df: DataFrame, flag_col: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """Undo :func:`union_sources`: (train rows, scoring rows)."""
    return df.filter(F.col(flag_col) == 0), df.filter(F.col(flag_col) == 1)


# --- sinks ---------------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write features (no row-number column).  CSV gets a header row."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def with_row_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """Prefix a 0-based row number in key order (the written-with-index form), computed by a
    distributed range sort rather than a single-task window."""
    numbered = row_number_within(df, [key], name=name)
    return numbered.select(name, *[c for c in df.columns])


def submission(scored: DataFrame, key: str, pred_col: str = "prediction", label_name: str = "label") -> DataFrame:
    """Id plus hard label, from a scored frame that still carries its key."""
    return scored.select(F.col(key), F.col(pred_col).cast("int").alias(label_name))


def label_sidecar(prepared: DataFrame, key: str, label: str) -> DataFrame:
    return prepared.select(key, label)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_date", T.DateType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])


def run_log_frame(spark: SparkSession, run_id: str, params: dict, run_date: _dt.date | None = None) -> DataFrame:
    """One row per parameter of a run (the ``key: value`` parameter file as a table)."""
    day = run_date or _dt.date.today()
    rows = [(run_id, day, str(k), None if v is None else str(v)) for k, v in params.items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(df: DataFrame, path: str) -> None:
    """Append run-log rows, partitioned by day."""
    df.write.mode("append").partitionBy("run_date").parquet(path)
