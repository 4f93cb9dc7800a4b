"""Keyed merge (U1) and the small keyed tables built on it (U2, state)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_parquet_or_none, staged_copy


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job on a NULL key instead of silently never matching it."""
    bad = None
    for k in keys:
        cond = F.col(k).isNull()
        bad = cond if bad is None else (bad | cond)
    msg = F.lit("upsert: NULL in unique key " + ", ".join(keys))
    guard = F.when(bad, F.raise_error(msg))
    return df.where(guard.isNull())


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE semantics without a transactional format.

    Target rows whose key appears in the source are replaced by the source
    row, new keys are added, nothing is deleted.  One anti join on the keys
    (AQE broadcasts the key side at runtime when it is small) plus a union.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(source)


def unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source; its write fails where a key occurs in more than one row."""
    name = F.lit("upsert: key occurs more than once in the source: " + ", ".join(keys))
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.when(F.col("__n") > 1, F.raise_error(name)).isNull()).select(*keys)


def touched_partitions(target: DataFrame, source: DataFrame, partition_col: str) -> DataFrame:
    """Target rows in the partitions the (staged) source touches.

    The distinct partition values, bounded by the calendar, come to the driver
    and go into the filter as literals, so the scan lists those partitions only.
    """
    values = [r[0] for r in source.select(partition_col).distinct().collect()]
    wanted = F.col(partition_col).isin([v for v in values if v is not None])
    return target.where(wanted | F.col(partition_col).isNull() if None in values else wanted)


def write_partitions(df: DataFrame, path: str, partition_col: str, mode: str = "dynamic") -> None:
    """Overwrite partitions, with rows rebalanced so that a day is few files.

    Adaptive execution splits a heavy day over several tasks and joins light
    ones, so the number of files follows the bytes, not tasks times days.
    """
    (df.hint("rebalance", F.col(partition_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy(partition_col).parquet(path))


def upsert_table(spark: SparkSession, path: str, source: DataFrame,
                 keys: Sequence[str], partition_col: str) -> DataFrame:
    """Merge ``source`` into the Parquet table at ``path``, partition-wise.

    The source is computed once, into the shared checkpoint folder; a NULL or
    repeated key fails the run before the target is touched.  Only the date
    partitions present in the source are read and rewritten.  The merge
    result is staged too, which cuts the lineage to the target files before
    they are replaced (a lost executor after that point recomputes from the
    staged copy, not from deleted files).
    """
    with staged_copy(reject_null_keys(source, keys), "upsert-source") as rows:
        unique_keys(rows, keys).write.format("noop").mode("overwrite").save()
        target = read_parquet_or_none(spark, path)
        if target is None:
            write_partitions(rows, path, partition_col, "static")
            return spark.read.parquet(path)
        merged = merge_rows(touched_partitions(target, rows, partition_col), rows, keys)
        with staged_copy(merged, "upsert-stage") as staged:
            write_partitions(staged, path, partition_col)
    return spark.read.parquet(path)


def upsert_keyed_small(target: DataFrame | None, source: DataFrame,
                       keys: Sequence[str]) -> DataFrame:
    """U1 for small keyed tables (state, watermark): whole-table result."""
    if target is None:
        return source
    return merge_rows(target, source, keys)


def watermark_row(spark: SparkSession, table_name: str, remote_max) -> DataFrame:
    """One watermark row: (table_name, remote_max text, updated_at = now)."""
    rm = remote_max if isinstance(remote_max, F.Column) else F.lit(
        None if remote_max is None else str(remote_max)).cast("string")
    return (spark.range(1).select(F.lit(table_name).alias("table_name"),
                                  rm.alias("remote_max"),
                                  F.current_timestamp().alias("updated_at")))
