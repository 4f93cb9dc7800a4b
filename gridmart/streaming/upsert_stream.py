"""Per micro-batch, latest row per grain merged into a keyed table.

Each batch is deduplicated (W1), then merged with the target rows of the
date partitions it touches, keeping per grain the row with the highest load
id -- so the result does not depend on the order in which batches arrive.
Only touched partitions are rewritten; a replayed batch gives the same
result (the merge is idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_latest
from ..operators.upsert import touched_partitions, write_partitions
from ..session import read_parquet_or_none, staged_copy

PART = "part_date"


def merge_latest(spark: SparkSession, path: str, batch: DataFrame, grain: Sequence[str],
                 time_col: str, load_col: str = "load_id",
                 tiebreak: Sequence[str] = ()) -> None:
    """Merge one batch into the table at ``path`` (latest load id wins)."""
    latest = dedupe_latest(batch, grain, order_by=(load_col,), tiebreak=tiebreak) \
        .withColumn(PART, F.to_date(F.col(time_col)))
    with staged_copy(latest, "stream-batch") as rows:
        target = read_parquet_or_none(spark, path)
        if target is None:
            write_partitions(rows, path, PART, "static")
            return
        rows = rows.select(*target.columns)
        both = touched_partitions(target, rows, PART).unionByName(rows)
        merged = dedupe_latest(both, grain, order_by=(load_col,), tiebreak=tiebreak)
        with staged_copy(merged, "stream-upsert") as staged:
            write_partitions(staged, path, PART)


def stream_upsert_latest(spark: SparkSession, source: DataFrame, path: str, checkpoint: str,
                         grain: Sequence[str], time_col: str, load_col: str = "load_id",
                         tiebreak: Sequence[str] = (), available_now: bool = True):
    """Run the merge for every micro-batch of a streaming DataFrame."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        merge_latest(spark, path, batch, grain, time_col, load_col, tiebreak)

    w = (source.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 minutes")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
