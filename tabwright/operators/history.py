"""Training-history operators (WIN5-WIN7): running best, patience stop, mean of the last points.

A history is the rows of one run (``run_keys``) in ``order_cols`` order, with a loss per row.

Patience (the early-stopping rule): a row is *ok* when its loss is not worse than the best loss
of all earlier rows (``<=``; ``strict=True`` makes it ``<``), the first row is ok; the counter is
the number of rows since the last ok row; training stops at the first row whose counter reaches
``patience``.  The best score only changes on ok rows, so it equals the running minimum.

Running minima and "last ok row" are prefix scans.  A run may be very long (one run may hold a
large share of all rows), so the scans are two-level: rows are numbered inside the run by a
distributed range sort, cut into chunks of ``chunk_rows`` consecutive steps, scanned inside each
chunk, and the chunk results are combined through per-chunk tables (one row per chunk), which carry
the state into the next chunks.  All joins and windows over rows are keyed by (run, chunk), so no
task holds more than one chunk of one run.  The numbered rows are written once; beside them only
chunk tables are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.operators.numbering import row_number_within
from tabwright.session import materialize

_NEG = -1


def _prefix_over_chunks(df: DataFrame, run_keys: list[str], value: str, how: str, out: str) -> DataFrame:
    """Per (run, chunk): aggregate of ``value`` over all *earlier* chunks of the run."""
    agg = F.min if how == "min" else F.max
    per_chunk = df.groupBy(*run_keys, "__chunk").agg(agg(value).alias("__v"))
    w = Window.partitionBy(*run_keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(*run_keys, "__chunk", agg("__v").over(w).alias(out))


def patience(df: DataFrame, run_keys, order_cols, loss: str, patience: int = 15, strict: bool = False,
             chunk_rows: int = 1_000_000) -> DataFrame:
    """Adds ``step`` (0-based), ``best`` (running min incl. this row), ``is_ok``, ``counter`` and
    ``is_stop`` (the first row of the run whose counter reaches ``patience``)."""
    run_keys = [run_keys] if isinstance(run_keys, str) else list(run_keys)
    cur = row_number_within(df, list(order_cols), run_keys, name="step")
    cur = materialize(cur.withColumn("__chunk", F.floor(F.col("step") / F.lit(chunk_rows))))
    by_chunk = run_keys + ["__chunk"]
    local = Window.partitionBy(*by_chunk).orderBy("step")
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    # best loss of all earlier chunks, then of all earlier rows
    best_in = materialize(_prefix_over_chunks(cur, run_keys, loss, "min", "__cmin"))
    rows = cur.withColumns({"__lmin_before": F.min(loss).over(before), "__lmin_upto": F.min(loss).over(upto)})
    rows = rows.join(best_in, by_chunk, "left")
    best_before = F.least(F.col("__cmin"), F.col("__lmin_before"))
    better = (F.col(loss) < best_before) if strict else (F.col(loss) <= best_before)
    rows = rows.withColumns({"best": F.least(F.col("__cmin"), F.col("__lmin_upto")),
                             "is_ok": best_before.isNull() | better})
    rows = rows.withColumn("__okstep", F.when(F.col("is_ok"), F.col("step")).otherwise(F.lit(_NEG)))
    # step of the last ok row up to this one
    ok_in = materialize(_prefix_over_chunks(rows, run_keys, "__okstep", "max", "__cok"))
    rows = rows.withColumn("__lok", F.max("__okstep").over(upto)).join(ok_in, by_chunk, "left")
    rows = rows.withColumn("counter", F.col("step") - F.greatest(F.col("__lok"), F.coalesce(F.col("__cok"), F.lit(_NEG))))
    # the first row that reaches the patience, found per run and looked up by its chunk
    stops = materialize(rows.filter(F.col("counter") >= patience).groupBy(*run_keys).agg(F.min("step").alias("__stop"))
                        .withColumn("__chunk", F.floor(F.col("__stop") / F.lit(chunk_rows))))
    rows = rows.join(stops, by_chunk, "left")
    rows = rows.withColumn("is_stop", F.coalesce(F.col("step") == F.col("__stop"), F.lit(False)))
    return rows.drop("__chunk", "__lmin_before", "__lmin_upto", "__cmin", "__okstep", "__lok", "__cok", "__stop")


def stop_points(hist: DataFrame, run_keys) -> DataFrame:
    """One row per run: stop step (null when it never stops), best loss and its first step."""
    run_keys = [run_keys] if isinstance(run_keys, str) else list(run_keys)
    return hist.groupBy(*run_keys).agg(
        F.min(F.when(F.col("is_stop"), F.col("step"))).alias("stop_step"),
        F.min("best").alias("best_loss"),
        F.count(F.lit(1)).alias("n_steps"))


def tail_mean(df: DataFrame, run_keys, order_cols, value: str, n: int = 10, digits: int = 3,
              out: str = "tail_mean") -> DataFrame:
    """WIN5: mean of the last ``n`` values of each run, rounded.  The ``row_number() <= n``
    filter lets Spark insert a partial per-task group limit before the shuffle, so at most
    ``n`` rows per run and task are moved, however long a run is."""
    run_keys = [run_keys] if isinstance(run_keys, str) else list(run_keys)
    w = Window.partitionBy(*run_keys).orderBy(*[F.col(c).desc() for c in order_cols])
    last = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    return last.groupBy(*run_keys).agg(F.round(F.avg(value), digits).alias(out),
                                       F.count(F.lit(1)).alias("n_points"))
