"""Newly landed files -> raw append table, each file exactly once.

A file stream source remembers which files it has processed in its
checkpoint (the state of the change detection), so every landed file is
read once.  Each micro-batch is written to its own ``load_id=<batch id>``
partition with dynamic overwrite: a batch replayed after a failure rewrites
the same partition instead of appending twice.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tsv import scan_instrument


def landed_files_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming paths of landed files (one row for each line; the content is not kept)."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
            .load(landing_dir).select(F.col("_metadata.file_path").alias("file_path")))


def write_load(batch: DataFrame, raw_path: str, load_id: int) -> None:
    """Idempotent append of one load: its own partition, overwritten on replay."""
    (batch.withColumn("load_id", F.lit(int(load_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id").parquet(raw_path))


def stream_ingest_files(spark: SparkSession, landing_dir: str, raw_path: str,
                        checkpoint: str, instrument: str, load_id_base: int = 0,
                        max_files_per_trigger: int = 100, available_now: bool = True,
                        multi_line: bool | str = "auto"):
    """Start (and with ``available_now`` run to completion) the ingest stream.

    Returns the StreamingQuery.  Load id = ``load_id_base + batch id``.
    """
    rows = landed_files_stream(spark, landing_dir, max_files_per_trigger)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # At most max_files_per_trigger paths; their files are read whole, once.
        paths = [unquote(r["file_path"]) for r in batch.distinct().collect()]
        if paths:
            write_load(scan_instrument(spark, paths, instrument, multi_line=multi_line).drop("file_path"),
                       raw_path, load_id_base + batch_id)

    w = (rows.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 minutes")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
