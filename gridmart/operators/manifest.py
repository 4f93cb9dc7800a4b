"""File manifest algebra: selection, ordering, change detection."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filename_to_folder, normalize_filename, strip_text, year_prefix
from ..functions.timeutc import utc_value
from .dedupe import top_n_per_group
from .upsert import merge_rows


class MissingFilesError(RuntimeError):
    pass


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The export log (tab-separated, header) as (file_name, updated)."""
    raw = (spark.read.option("sep", "\t").option("header", True)
           .option("quote", '"').option("escape", '"').csv(path))
    cols = {c.strip(): c for c in raw.columns}
    name = F.col(f"`{cols['file_name']}`")
    upd_src = cols.get("max_update_time(UTC)")
    updated = F.col(f"`{upd_src}`") if upd_src else F.lit("")
    return (raw.select(F.coalesce(strip_text(name), F.lit("")).alias("file_name"),
                       F.coalesce(strip_text(updated), F.lit("")).alias("updated"))
            .where(F.col("file_name") != ""))


def annotate(manifest: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Add folder (M1), normalised filename (M2) and year (first 4 chars)."""
    filename = normalize_filename(name_col)
    return (manifest.withColumn("folder", filename_to_folder(name_col))
            .withColumn("filename", filename)
            .withColumn("year", year_prefix(filename)))


def order_key(updated_col: str = "updated", filename_col: str = "filename"):
    """M6 sort key: valid update times ascending, then unparseable ones by name."""
    ts = utc_value(updated_col)
    return F.struct(ts.isNull().alias("invalid"), ts.alias("ts"),
                    F.col(filename_col).alias("name"))


def select_files(manifest: DataFrame, folder: str | None = None,
                 years: Iterable | None = None) -> DataFrame:
    """M3/M4: rows of one instrument folder, optionally of some years."""
    df = annotate(manifest)
    if folder is not None:
        df = df.where(F.col("folder") == F.lit(folder))
    if years is not None:
        df = df.where(F.col("year").isin([str(y) for y in years]))
    return df


def select_named(manifest: DataFrame, wanted: Sequence[str], folder: str | None = None,
                 check: bool = True, years: Iterable | None = None) -> DataFrame:
    """M5: exactly the named files (of some years, M4); raise naming the missing ones, sorted.

    The wanted list is user input (a handful of names); only the missing
    names, at most that many, come back to the driver.
    """
    df = select_files(manifest, folder, years)
    spark = manifest.sparkSession
    wanted_df = spark.createDataFrame([(w,) for w in sorted(set(wanted))], "filename string")
    selected = df.join(wanted_df, "filename", "left_semi")
    if check:
        missing = [r[0] for r in wanted_df.join(selected.select("filename"), "filename",
                                                "left_anti").orderBy("filename").collect()]
        if missing:
            raise MissingFilesError("selected files not found: " + ", ".join(missing))
    return selected


def order_files(df: DataFrame) -> DataFrame:
    """M6: update order (malformed update times last, by file name)."""
    return df.withColumn("__k", order_key()).orderBy("__k").drop("__k")


def latest_per_folder(df: DataFrame) -> DataFrame:
    """M7 for every folder at once: the last file in M6 order.

    A grouped ``max_by`` aggregates partially before the shuffle, so a folder
    with a huge number of entries never lands whole in one task.
    """
    return (df.groupBy("folder")
            .agg(F.max_by(F.struct("filename", "updated"), order_key()).alias("m"))
            .select("folder", "m.filename", "m.updated"))


def changed_files(selected: DataFrame, state: DataFrame | None, force: bool = False) -> DataFrame:
    """M8: files with no state entry or a different update text (not newer)."""
    if force or state is None:
        return selected
    seen = state.select(F.col("filename"), F.col("updated").alias("__seen"))
    return (selected.join(seen, "filename", "left")
            .where(~F.col("updated").eqNullSafe(F.col("__seen")))
            .drop("__seen"))


def commit_state(state: DataFrame | None, loaded: DataFrame) -> DataFrame:
    """Record the manifest's update text of the given files.

    Of several entries of one file the last in update order (M6) is kept.
    """
    new = loaded.groupBy("filename").agg(F.max_by("updated", order_key()).alias("updated"))
    if state is None:
        return new
    return merge_rows(state.select("filename", "updated"), new, ["filename"])


def limit_files_per_group(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` files per (folder, year), by file name."""
    return top_n_per_group(df, ["folder", "year"], ["filename", "updated"], n)


def landed_unread(manifest: DataFrame, landed: DataFrame, overwrite: bool = False) -> DataFrame:
    """Manifest entries whose file is not in the landing area yet."""
    if overwrite:
        return manifest
    return manifest.join(landed.select("filename"), "filename", "left_anti")


def list_landed(spark: SparkSession, path: str, years: Iterable | None = None) -> DataFrame:
    """Landed files (name, path, size, mtime) from file metadata only.

    ``filename`` is the entry directly under the landing folder: a file, or
    a ``<name>.csv/`` folder of part files as Spark writes it (every part
    file is listed under that one name).  The binaryFile source reads
    content only when that column is selected.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    root = str(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
               .makeQualified(hpath).toString()).rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
          .select(F.regexp_extract("path", "^" + re.escape(root) + r"/([^/]+)", 1)
                  .alias("filename"), "path", "length", "modificationTime"))
    if years is not None:
        df = df.where(year_prefix("filename").isin([str(y) for y in years]))
    return df
