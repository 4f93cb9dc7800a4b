"""A tree of digests over a date-partitioned table, for finding edits of any age.

A day's digest is order-free and mergeable: the number of rows and two sums of
independent row hashes.  Days are summed to months, months to the table.  The tree of a source and that of its
replica are compared from the top, and only below nodes that differ, so
an edit in place of an old day, which no overlap window sees, is found as that one day.

A tree is kept with the listing (names, lengths, times) of each day's files
and with the table's schema.  To bring it up to date only days whose listing has
changed are read; a day that was rewritten with the same rows gets the same digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import write_partitions
from ..session import delete_path, read_parquet_or_none, read_version, write_version

PART = "part_date"
#: The folder name of rows without a partition value, which is Spark's.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
TREE = "level string, node string, branch string, row_count long, first decimal(38,0), second decimal(38,0), files string"
_SUMS = ("row_count", "first", "second")


def day_text(part_col: str) -> Column:
    """A partition value as text, a missing one too."""
    return F.coalesce(F.col(part_col).cast("string"), F.lit(NO_DAY))


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of a row that tells apart where its nulls are."""
    flags = [x for c in sorted(columns) for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *flags).cast("decimal(38,0)")


def day_digests(table: DataFrame, part_col: str = PART) -> DataFrame:
    """(node, row_count, first, second) of each day."""
    columns = [c for c in table.columns if c != part_col]
    return table.groupBy(day_text(part_col).alias("node")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(row_hash(columns, 1)).alias("first"),
        F.sum(row_hash(columns, 2)).alias("second"))


def roll_up(days: DataFrame) -> DataFrame:
    """The whole tree over day rows (node, sums, files): days, months of days, the table of months."""
    leaves = days.select(F.lit("day").alias("level"), "node", F.substring("node", 1, 7).alias("branch"), *_SUMS, "files")

    def above(rows: DataFrame, level: str, branch: Column) -> DataFrame:
        return rows.groupBy(F.col("branch").alias("node")).agg(
            *[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in _SUMS]).select(
            F.lit(level).alias("level"), "node", branch.alias("branch"), *_SUMS, F.lit(None).cast("string").alias("files"))

    months = above(leaves, "month", F.lit("table"))
    return leaves.unionByName(months).unionByName(above(months, "table", F.lit(None).cast("string")))


def day_listing(spark: SparkSession, table: DataFrame, table_path: str, part_col: str) -> DataFrame:
    """(node, files): what the files of each day look like from outside; no content is read."""
    schema = F.xxhash64(F.lit(table.schema.simpleString())).cast("decimal(38,0)")
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return (spark.read.format("binaryFile").load(table_path).groupBy(day_text(part_col).alias("node"))
            .agg(F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), F.sum(one) + schema).alias("files")))


def refresh_tree(spark: SparkSession, table_path: str, tree_path: str, part_col: str = PART) -> DataFrame:
    """The tree of the table as it is now; only days whose files have changed are read."""
    table, before = read_parquet_or_none(spark, table_path), read_version(spark, tree_path)
    if table is None:
        write_version(spark.createDataFrame([], TREE), tree_path)
        return read_version(spark, tree_path)
    files = day_listing(spark, table, table_path, part_col)
    known = before.where("level = 'day'") if before is not None else spark.createDataFrame([], TREE)
    todo = [r["node"] for r in files.join(known, ["node", "files"], "left_anti").collect()]  # days, of the calendar
    kept = known.join(files, ["node", "files"], "left_semi").select("node", *_SUMS, "files")
    if before is not None and not todo and kept.count() == known.count():
        return before
    days = kept
    if todo:
        fresh = day_digests(table.where(day_text(part_col).isin(todo)), part_col)
        days = kept.unionByName(fresh.join(files, "node").select(*kept.columns))
    write_version(roll_up(days).coalesce(1), tree_path)
    return read_version(spark, tree_path)


def unequal(source: DataFrame, replica: DataFrame, level: str, branches: Sequence[str] | None = None) -> list[str]:
    """The nodes of a level, below the given branches, whose digests differ or that one tree lacks."""
    def nodes(tree: DataFrame, suffix: str) -> DataFrame:
        rows = tree.where(F.col("level") == level)
        if branches is not None:
            rows = rows.where(F.col("branch").isin(list(branches)))
        return rows.select("node", F.struct(*_SUMS).alias(suffix))

    both = nodes(source, "a").join(nodes(replica, "b"), "node", "full")
    return sorted(r["node"] for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect())


def unequal_days(source: DataFrame, replica: DataFrame) -> list[str]:
    """The days in which two trees differ, found from the top down."""
    if not unequal(source, replica, "table"):
        return []
    return unequal(source, replica, "day", unequal(source, replica, "month", ["table"]))


def copy_days(spark: SparkSession, source_path: str, replica_path: str, days: Sequence[str], part_col: str = PART) -> None:
    """Make these days of the replica equal to the source's; other days are neither read nor written.

    Days that the source lacks are dropped first; the others are overwritten
    one partition at a time, so that a run that was cut off is finished by the next one.
    """
    source = spark.read.parquet(source_path).where(day_text(part_col).isin(list(days)))
    there = {r[0] for r in source.select(day_text(part_col)).distinct().collect()}
    for day in sorted(set(days) - there):
        delete_path(spark, f"{replica_path.rstrip('/')}/{part_col}={day}")
    if there:
        write_partitions(source, replica_path, part_col)


def sync_days(spark: SparkSession, source_path: str, replica_path: str, trees_root: str, table: str,
              part_col: str = PART) -> tuple[str, list[str]]:
    """U3 by digests: (action, days that were copied or dropped).

    ``full-copy`` if there is no replica, ``skip`` if the trees are equal, else ``resync``.
    """
    root = f"{trees_root.rstrip('/')}/{table}"
    source = refresh_tree(spark, source_path, f"{root}/source", part_col)
    missing = read_parquet_or_none(spark, replica_path) is None
    replica = refresh_tree(spark, replica_path, f"{root}/replica", part_col)
    days = unequal_days(source, replica)
    if not days:
        return "skip", []
    copy_days(spark, source_path, replica_path, days, part_col)
    refresh_tree(spark, replica_path, f"{root}/replica", part_col)
    return "full-copy" if missing else "resync", days
