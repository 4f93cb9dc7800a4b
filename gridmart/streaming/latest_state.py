"""Z2 as a stateful operator: the latest row per grain, as a log of changes.

Each grain is a key; its state is the rank of its winner so far (load id, tie
breaks, row hash: the order of W1), a few numbers in RocksDB.  A row that does not beat
it is a replay or out of order and goes no further.  The winners of a micro-batch are appended to
the change log; nothing that was written before is read or rewritten.  The table
is the log's latest row per grain (``read_latest``), and ``compact`` folds the log into
date partitions from time to time.

State is bounded by event time: the watermark trails the newest instant by the
overlap, and a timer drops a grain's state once the watermark passes its instant.  A row
that comes later than that has no state to be held against; it is appended to the
log as it is, and the reader's order decides.  So the table equals W1 over
all rows however late they come, while state holds the grains of the overlap only.

Spark drops rows behind the watermark before a stateful operator.  To keep
them, the watermark is fed by rows of its own: every row is sent twice, as data
without a clock and as a clock without data, and the latter go no further than
the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedupe import dedupe_latest
from ..session import delete_path, read_parquet_or_none
from .manifest_state import rocksdb_state
from .upsert_stream import PART, merge_latest

OVERLAP_DAYS = 2
#: Rows travel through the stateful operator as text, so that every type comes out as it went in.
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
         "ignoreNullFields": "false"}
_LEAST = -(1 << 63)
LOG, BASE = "changes", "base"


def _number(df: DataFrame, column: str):
    """A column of the order as a whole number, nulls last in falling order."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value).cast("long")
    elif isinstance(kind, T.IntegralType):
        value = value.cast("long")
    else:
        raise TypeError(f"{column} is of type {kind.simpleString()}; the order takes whole numbers, dates and instants")
    return F.coalesce(value, F.lit(_LEAST))


def _winner(width: int, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The best row of a grain in a batch, if it beats the state; the state goes when its timer fires."""
    if state.hasTimedOut:
        state.remove()
        return
    names = [f"o{k}" for k in range(width)]
    best, instant = None, None
    for rows in batches:
        for rank, text, at in zip(rows[names].itertuples(index=False, name=None), rows["row"], rows["instant"], strict=True):
            instant = at
            if best is None or rank > best[0]:
                best = rank, text
    if best is None or (state.exists and tuple(state.get) >= tuple(best[0])):
        return
    if instant > state.getCurrentWatermarkMs():
        state.update(tuple(int(x) for x in best[0]))
        state.setTimeoutTimestamp(int(instant) + 1)
    yield pd.DataFrame({"row": [best[1]]})


def changed_rows(source: DataFrame, grain: Sequence[str], time_col: str, load_col: str = "load_id",
                 tiebreak: Sequence[str] = (), overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """Streaming rows of ``source`` that are, when they come, the latest of their grain.

    ``time_col`` is in the grain, so a grain has one instant.
    """
    if time_col not in grain:
        raise ValueError("the time column belongs to the grain")
    order = [_number(source, c) for c in (load_col, *tiebreak)] + [F.xxhash64(*[F.col(c) for c in source.columns])]
    instant = F.unix_millis(F.col(time_col).cast("timestamp"))
    data = source.select(F.to_json(F.struct(*grain), _TEXT).alias("grain"), F.to_json(F.struct("*"), _TEXT).alias("row"),
                         F.coalesce(instant, F.lit(_LEAST)).alias("instant"), F.col(time_col).cast("timestamp").alias("at"),
                         *[c.alias(f"o{k}") for k, c in enumerate(order)])
    both = data.select("*", F.explode(F.array(F.lit(None).cast("timestamp"), F.col("at"))).alias("clock")).drop("at")
    rows = both.withWatermark("clock", f"{max(0, int(overlap_days))} days").where("clock IS NULL")
    state = ", ".join(f"o{k} long" for k in range(len(order)))
    won = rows.groupBy("grain").applyInPandasWithState(
        partial(_winner, len(order)), "row string", state, "append", GroupStateTimeout.EventTimeTimeout)
    return won.select(F.from_json("row", source.schema, _TEXT).alias("row")).select("row.*")


def stream_latest(spark: SparkSession, source: DataFrame, path: str, checkpoint: str, grain: Sequence[str],
                  time_col: str, load_col: str = "load_id", tiebreak: Sequence[str] = (),
                  overlap_days: int = OVERLAP_DAYS, available_now: bool = True):
    """Append the changes of every micro-batch to ``path``; returns the StreamingQuery.

    A batch's changes are its own partition of the log, overwritten on replay.
    """
    changes = changed_rows(source, grain, time_col, load_col, tiebreak, overlap_days)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(f"{path}/{LOG}"))

    w = changes.writeStream.foreachBatch(per_batch).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 minutes")
    with rocksdb_state(spark):
        q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def read_latest(spark: SparkSession, path: str, grain: Sequence[str], time_col: str, load_col: str = "load_id",
                tiebreak: Sequence[str] = ()) -> DataFrame | None:
    """The table: the latest row per grain of the compacted part and the log.

    Only days that the log touches, bounded by the calendar, are ranked again; the others are read as they are.
    """
    log, base = (read_parquet_or_none(spark, f"{path}/{part}") for part in (LOG, BASE))
    if log is None:
        return None if base is None else base.drop(PART)
    log = log.drop("_batch")
    if base is None:
        return dedupe_latest(log, grain, order_by=(load_col,), tiebreak=tiebreak)
    days = [r[0] for r in log.select(F.to_date(time_col)).distinct().collect()]
    touched = F.coalesce(F.col(PART).isin([d for d in days if d is not None]), F.lit(None in days))
    again = log.unionByName(base.where(touched).drop(PART))
    return (dedupe_latest(again, grain, order_by=(load_col,), tiebreak=tiebreak)
            .unionByName(base.where(~touched).drop(PART)))


def compact(spark: SparkSession, path: str, grain: Sequence[str], time_col: str, load_col: str = "load_id",
            tiebreak: Sequence[str] = ()) -> None:
    """Fold the log into the base, date partition by date partition, then drop the batches that are in it.

    A crash in between leaves rows in both, which the reader's order takes once.
    Not to be run while the stream is writing.
    """
    log = read_parquet_or_none(spark, f"{path}/{LOG}")
    if log is None:
        return
    batches = [r[0] for r in log.select("_batch").distinct().collect()]  # partition values
    merge_latest(spark, f"{path}/{BASE}", log.drop("_batch"), grain, time_col, load_col, tiebreak)
    for number in batches:
        delete_path(spark, f"{path}/{LOG}/_batch={number}")
