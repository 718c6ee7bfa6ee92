"""Incremental file ingestion with Structured Streaming.

A landing folder is read as a file stream; ``trigger(availableNow=True)``
processes every file not yet seen and stops, and the checkpoint (in the
shared folder) records which files were taken, so the next run sees only
new files.  ``foreachBatch`` hands each micro-batch to a sink; the sinks
here are idempotent per batch id, because a batch may be replayed after a
failure.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.taskqueue import TaskQueue
from tierline.sinks.files import CSV_OPTIONS

BatchSink = Callable[[DataFrame, int], None]


def ingest_new_files(spark: SparkSession, source_dir: str, schema: T.StructType,
                     checkpoint: str, sink: BatchSink, fmt: str = "csv",
                     options: dict[str, str] | None = None, once: tuple[str, str, str] | None = None) -> None:
    """Process the files that arrived since the last run, then stop.

    ``once``: (key, event-time column, delay) drops rows whose key was seen
    within the delay of the event-time watermark; the state of keys older
    than that is given up, so it stays bounded.  What comes later than the
    delay passes again, for an idempotent sink.
    """
    opts = {"header": "true", **CSV_OPTIONS} if fmt == "csv" else {}
    opts.update(options or {})
    stream = spark.readStream.format(fmt).schema(schema).options(**opts).load(source_dir)
    if once:
        key, seen_at, delay = once
        stream = stream.withWatermark(seen_at, delay).dropDuplicatesWithinWatermark([key])
    q = (stream.writeStream.foreachBatch(sink)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def batch_folder_sink(out_dir: str) -> BatchSink:
    """Write each batch to ``out_dir/batch_no=<id>``; a replayed batch
    replaces its own folder only."""
    def sink(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_no", F.lit(batch_id).cast("int"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("batch_no").parquet(out_dir))
    return sink


def queue_sink(queue: TaskQueue) -> BatchSink:
    """Upsert the task keys of each batch into a queue (insert-or-ignore,
    so a replayed batch adds nothing)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        queue.upsert(df.select("season_id", "event_id", "category_id",
                               F.col("id").alias("session_id")))
    return sink
