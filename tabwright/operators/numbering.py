"""Distributed row numbers (global, or within groups) without a single-task window.

``row_number().over(Window.orderBy(...))`` with no ``partitionBy`` moves every row into one task,
and ``partitionBy(group)`` moves a whole hot group into one task.  Instead the rows are
range-partitioned on (group, order) so that any group may span many partitions, each partition
is sorted locally, and the position inside a partition comes from
``monotonically_increasing_id`` (partition index in the upper bits, position in the lower 33).
A table with one row per partition (its size is bounded by the partition count, so it can be
broadcast safely) turns partition positions into global positions; a per-group minimum turns
those into positions within the group.

Range bounds come from sampling, and the sample depends on the order rows arrive in, so two
evaluations of the same range shuffle may cut the data differently.  The tagged rows are
therefore written once with a reliable ``checkpoint()`` (to ``spark.checkpoint.dir``) and both
the per-partition counts and the positions are read from that one copy.  The order columns must
form a unique key (append the id) for the numbers to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.session import ensure_checkpoint_dir

_PID = "__tw_pid"
_POS = "__tw_pos"
_OFF = "__tw_off"
_GRN = "__tw_grn"


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def row_number_within(df: DataFrame, order_cols, group_cols=(), name: str = "row_num",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based ``name`` numbering rows by ``order_cols`` inside each ``group_cols`` group
    (globally when no group is given)."""
    group_cols = list(group_cols)
    keys = _as_cols(group_cols) + _as_cols(order_cols)
    # without a stated count AQE sizes the range partitions from the data
    spread = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (spread
              .sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    # One row per non-empty partition: bounded by the partition count, so broadcasting it is safe.
    offsets = (ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn(_OFF, F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
               .select(_PID, F.coalesce(F.col(_OFF), F.lit(0)).alias(_OFF)))
    numbered = (ranged.join(F.broadcast(offsets), _PID)
                .withColumn(_GRN, F.col(_OFF) + F.col(_POS))
                .drop(_PID, _POS, _OFF))
    if not group_cols:
        return numbered.withColumnRenamed(_GRN, name)
    # Start of each group = its smallest global number; groups are contiguous in the global order.
    starts = numbered.groupBy(*group_cols).agg(F.min(_GRN).alias("__start"))
    starts = starts.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group_cols)], "__start")
    cond = [numbered[c].eqNullSafe(starts[f"__g{i}"]) for i, c in enumerate(group_cols)]
    return (numbered.join(starts, cond)
            .withColumn(name, F.col(_GRN) - F.col("__start"))
            .drop(_GRN, "__start", *[f"__g{i}" for i in range(len(group_cols))]))
