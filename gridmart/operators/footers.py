"""Counts and extremes of Parquet tables from file footers alone.

Row counts and column statistics stand in every file's footer, and Spark's
DataSource V2 reader can answer an aggregate from them.  That reader is asked for
in a session of its own, so the caller's settings stay.  Where footers do
not decide (a filter on data, a type without statistics, files written without them) the same
query scans; ``pushed`` tells which it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true",
             "spark.sql.session.timeZone": "UTC"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same context whose Parquet scans take aggregates."""
    own = spark.newSession()
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    return own


def footer_range(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``row_count``, and ``min_<c>``, ``max_<c>`` for each column."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for c in columns:
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    found = footer_session(spark).read.parquet(path).agg(*aggregates)
    # A pushed count is the sum of the files' counts, which is null where no file has a row; Spark
    # takes a count for never null, and would drop a plain coalesce.
    counted = F.nullif("row_count", F.lit(-1).cast("long"))
    return found.withColumn("row_count", F.coalesce(counted, F.lit(0).cast("long")))


def pushed(df: DataFrame) -> bool:
    """Whether a query's aggregate is answered by footers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan
