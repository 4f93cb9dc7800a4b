"""Fact-to-dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact to a dimension; left by default so no fact row is lost.

    Dimension columns that clash with fact columns (other than the key) are
    dropped from the dimension side.  No job runs here and nothing is kept:
    Spark broadcasts the dimension where its size in bytes, from statistics
    or as measured at run time, is below the session's threshold.
    """
    keys = [on] if isinstance(on, str) else list(on)
    extra = [c for c in dim.columns if c not in keys and c not in fact.columns]
    return fact.join(dim.select(*keys, *extra), on=keys, how=how)


def dedupe_dim(dim: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Opt-in: one dimension row per key (first by ``order_by`` ascending)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return dim.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
