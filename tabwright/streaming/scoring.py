"""Scoring rows as they arrive (the reference's last step, on a file stream).

Prepared scoring rows land as parquet files in a folder; a Structured Streaming query picks up new
files, scores them with an already fitted pipeline and writes ``(key, label)`` submission rows.
Each micro-batch is written to its own ``batch_id`` partition with dynamic overwrite, so a batch
that is replayed after a failure replaces its own output instead of duplicating it; the stream's
progress lives in ``checkpoint_dir`` (a shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.plans import models
from tabwright.sources import io


def score_stream(spark: SparkSession, source_dir: str, schema, model: PipelineModel, key: str, sink_dir: str,
                 checkpoint_dir: str, threshold: float = 0.5, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = models.score(model, batch, key, threshold, keep=())
        (io.submission(scored, key, "prediction", "label")
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))

    writer = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
