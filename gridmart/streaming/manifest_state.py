"""Z1 by manifest state: files are read when the export log says that they changed.

The stream's rows are the entries of the export logs as they arrive.  Each file name is a
key with the update text it was last read at as state, kept by Spark in
the checkpoint; an entry whose text differs from it (M8: differs, not newer) is a
change.  So a file that is published again under its name is read again, and one whose
entry is repeated is not.  The rows of a micro-batch go to its own ``load_id``
partition, which a replay overwrites; Spark commits the state after the batch (M11),
so a batch that failed finds the state of the one before.

A changed file that has not landed yet is put off: each batch leaves the list of
such files under its own number, and the next batch tries them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import filename_to_folder, normalize_filename, strip_text
from ..operators.manifest import list_landed, order_key
from ..schemas import INSTRUMENTS
from ..session import path_exists, staged_copy
from ..sources.tsv import scan_instrument
from .ingest import write_load

ENTRY = "filename string, updated string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: on disk, not in the executors' heap."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def manifest_entries(spark: SparkSession, manifest_dir: str, logs_per_trigger: int = 1) -> DataFrame:
    """Streaming (file_name, updated) of the export logs under ``manifest_dir``, by column name.

    A log is one row of the text source, as its first line says where the
    columns are; its entries are taken out in the JVM.
    """
    logs = spark.readStream.option("maxFilesPerTrigger", logs_per_trigger).text(manifest_dir, wholetext=True)

    def cells(line):
        return F.transform(F.split(line, "\t"), lambda c: strip_text(F.regexp_replace(strip_text(c), '^"|"$', "")))

    lines = F.filter(F.split("value", "\r?\n"), lambda x: strip_text(x) != "")
    rows = (logs.select(lines.alias("lines")).where(F.size("lines") > 1)
            .select(cells(F.col("lines")[0]).alias("header"), F.explode(F.slice("lines", 2, F.size("lines") - 1)).alias("line"))
            .select("header", cells(F.col("line")).alias("cells")))

    def cell(name: str):
        return F.coalesce(F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1), F.lit(""))

    return (rows.select(cell("file_name").alias("file_name"), cell("max_update_time(UTC)").alias("updated"))
            .where("file_name <> ''"))


def _when_changed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Of a file's entries the last in update order (M6), if it differs from the state."""
    text = max(row for rows in batches for row in zip(rows["invalid"], rows["at"], rows["updated"], strict=True))[2]
    if not state.exists or state.get[0] != text:
        state.update((text,))
        yield pd.DataFrame({"filename": [key[0]], "updated": [text]})


def changed_entries(entries: DataFrame) -> DataFrame:
    """Streaming M8: (filename, updated) of the files whose update text is not the one they were last read at."""
    named = entries.withColumn("filename", normalize_filename("file_name"))
    key = order_key()
    rows = named.select("filename", F.coalesce(F.unix_micros(key["ts"]), F.lit(0)).alias("at"),
                        key["invalid"].alias("invalid"), "updated")
    return rows.groupBy("filename").applyInPandasWithState(
        _when_changed, ENTRY, "updated string", "append", GroupStateTimeout.NoTimeout)


def _put_off(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the last batch before this one put off, or None."""
    if not path_exists(spark, path):
        return None
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)]
    before = [n for n in (int(x[6:]) for x in names if x.startswith("batch=")) if n < batch_id]
    return spark.read.schema(ENTRY).parquet(f"{path}/batch={max(before)}") if before else None


def stream_ingest_manifest(spark: SparkSession, manifest_dir: str, landing_dir: str, raw_path: str, checkpoint: str,
                           instrument: str, load_id_base: int = 0, logs_per_trigger: int = 1,
                           available_now: bool = True, seed: bool = False, multi_line: bool | str = "auto",
                           index_path: str | None = None):
    """Read the instrument's landed files that the export logs report as new or changed.

    Load id = ``load_id_base + batch id``.  ``seed`` records the update texts of
    the logs that are there and loads nothing (M9).  Returns the StreamingQuery.
    """
    inst = INSTRUMENTS[instrument]
    entries = manifest_entries(spark, manifest_dir, logs_per_trigger)
    changed = changed_entries(entries.where(filename_to_folder("file_name") == inst.folder))
    put_off = f"{raw_path.rstrip('/')}-put-off"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if seed:
            batch.write.format("noop").mode("overwrite").save()
            return
        with staged_copy(batch, "changed-files") as fresh:  # the stateful plan is run once
            before = _put_off(spark, put_off, batch_id)
            todo = fresh if before is None else fresh.unionByName(before.join(fresh, "filename", "left_anti"))
            if path_exists(spark, landing_dir):
                todo = todo.join(list_landed(spark, landing_dir).select("filename", "path"), "filename", "left")
            else:
                todo = todo.withColumn("path", F.lit(None).cast("string"))
            paths = [r["path"] for r in todo.where("path IS NOT NULL").select("path").collect()]
            if paths:
                rows = scan_instrument(spark, paths, inst, multi_line=multi_line, index_path=index_path)
                write_load(rows.drop("file_path"), raw_path, load_id_base + batch_id)
            (todo.where("path IS NULL").select("filename", "updated").coalesce(1)
             .write.mode("overwrite").parquet(f"{put_off}/batch={batch_id}"))

    w = changed.writeStream.foreachBatch(per_batch).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 minutes")
    with rocksdb_state(spark):
        q = w.start()
    if available_now:
        q.awaitTermination()
    return q
