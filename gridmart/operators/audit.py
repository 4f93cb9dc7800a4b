"""Load progress from ingest log text (L1), as one Spark job over the lines."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Log line formats written by the ingest step.
STARTED_LINE = r"\[entsoe:([^\]]+)\] pobieram (\S+)"
DONE_LINE = r"\[entsoe:([^\]]+)\] gotowe \S+ \((\d+) wierszy"
STAMP = r"\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\]"
RUN_START = "START dlt-backfill"
# Expected files per resource for two years of data.
EXPECTED_FILES = {
    "energy_prices": 0,
    "imbalance_prices": 21,
    "generation_forecasts": 21,
    "aggregated_generation": 21,
}


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a log file set with an order: by file name, then as written.

    A file's splits are read by tasks in the order of their offsets, so an id
    that grows within the job orders the lines of one file.
    """
    return (spark.read.text(path)
            .withColumn("line_id", F.struct(F.col("_metadata.file_path").alias("file"),
                                            F.col("_metadata.file_block_start").alias("block"),
                                            F.monotonically_increasing_id().alias("line"))))


def parse_events(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Per line: resource, kind (started / done), file, rows."""
    t = F.col(text_col)
    started_res = F.regexp_extract(t, STARTED_LINE, 1)
    done_res = F.regexp_extract(t, DONE_LINE, 1)
    return (lines.select(
        "*",
        F.when(started_res != "", started_res).otherwise(
            F.when(done_res != "", done_res)).alias("resource"),
        F.when(started_res != "", F.lit("started"))
         .when(done_res != "", F.lit("done")).alias("kind"),
        F.when(started_res != "", F.regexp_extract(t, STARTED_LINE, 2)).alias("file"),
        F.when(done_res != "", F.regexp_extract(t, DONE_LINE, 2).cast("long")).alias("rows"))
        .where(F.col("kind").isNotNull()))


def expected_frame(spark: SparkSession, expected: Mapping[str, int] | None = None) -> DataFrame:
    expected = EXPECTED_FILES if expected is None else expected
    return spark.createDataFrame([(k, int(v)) for k, v in expected.items()],
                                 "resource string, expected long")


def load_progress(events: DataFrame, expected: DataFrame, order_col: str = "line_id") -> DataFrame:
    """Per resource with expected > 0: started, done, rows, last started file.

    One grouped aggregation (partial before the shuffle) joined to the small
    expected table; resources outside the expected table are left out, like
    resources expected 0.
    """
    per = (events.groupBy("resource").agg(
        F.count_if(F.col("kind") == "started").alias("started"),
        F.count_if(F.col("kind") == "done").alias("done"),
        F.coalesce(F.sum(F.when(F.col("kind") == "done", F.col("rows"))), F.lit(0))
         .cast("long").alias("rows"),
        F.max_by(F.when(F.col("kind") == "started", F.col("file")),
                 F.when(F.col("kind") == "started", F.col(order_col))).alias("last_file")))
    return (F.broadcast(expected).join(per, "resource", "left")
            .where(F.col("expected") > 0)
            .select("resource", "expected",
                    F.coalesce("started", F.lit(0)).cast("long").alias("started"),
                    F.coalesce("done", F.lit(0)).cast("long").alias("done"),
                    F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
                    "last_file"))


def run_start(lines: DataFrame, text_col: str = "value", order_col: str = "line_id"):
    """First stamped line containing the run-start marker (one row or none)."""
    stamp = F.regexp_extract(F.col(text_col), STAMP, 1)
    return (lines.where(F.col(text_col).contains(RUN_START) & (stamp != ""))
            .agg(F.min_by(stamp, F.col(order_col)).alias("t0")))


def load_totals(events: DataFrame, expected: DataFrame, start: DataFrame, now: _dt.datetime,
                order_col: str = "line_id") -> DataFrame:
    """One row over all resources, those expected 0 or not expected included.

    expected, started, done, rows, the overall last file, files per minute
    since the run's start and minutes left at that pace (both NULL before the
    first file or without a start line).  A run counts as a tenth of a minute
    old at least, and as loading a hundredth of a file per minute at least.
    """
    is_start = F.col("kind") == "started"
    seen = events.agg(
        F.count_if(is_start).alias("started"), F.count_if(F.col("kind") == "done").alias("done"),
        F.coalesce(F.sum(F.when(F.col("kind") == "done", F.col("rows"))), F.lit(0)).cast("long").alias("rows"),
        F.max_by(F.when(is_start, F.col("file")), F.when(is_start, F.col(order_col))).alias("last_file"))
    goal = expected.agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"))
    age = F.unix_timestamp(F.lit(now.strftime("%Y-%m-%d %H:%M:%S"))) - F.unix_timestamp("t0")
    pace = F.when(F.col("started") > 0, F.col("started") / F.greatest(age / 60, F.lit(0.1)))
    # Three one-row relations side by side.
    one = [d.withColumn("one", F.lit(1)) for d in (seen, goal, start)]
    return (one[0].join(one[1], "one").join(one[2], "one").drop("one")
            .withColumn("files_per_minute", pace)
            .withColumn("minutes_left", F.greatest(F.col("expected") - F.col("started"), F.lit(0))
                        / F.greatest("files_per_minute", F.lit(0.01)))
            .withColumn("minutes_left", F.when(F.col("files_per_minute").isNotNull(), F.col("minutes_left")))
            .select("expected", "started", "done", "rows", "last_file", "files_per_minute", "minutes_left"))


def status_lines(progress: DataFrame, totals: DataFrame) -> list[str]:
    """The progress of each resource and the totals as text (a handful of rows)."""
    t = totals.first()
    text = [f"{r['resource']}: {r['started']} of {r['expected']} files begun, {r['done']} finished, "
            f"{r['rows']} rows, last {r['last_file']}" for r in progress.orderBy("resource").collect()]
    text.append(f"all: {t['started']} of {t['expected']} files begun, {t['done']} finished, {t['rows']} rows, "
                f"last {t['last_file']}")
    if t["files_per_minute"] is not None:
        text.append(f"pace {t['files_per_minute']:.1f} files a minute, {t['minutes_left']:.0f} minutes to go")
    return text
