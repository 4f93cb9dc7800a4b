"""Latest row per business grain (W1) and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def dedupe_latest(df: DataFrame, grain: Sequence[str],
                  order_by: Sequence[str] = ("load_id",),
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per grain: highest ``order_by`` first.

    Ties (rows of one load) are broken by ``tiebreak`` columns, newest first
    with NULLs last, then by a hash of the whole row, so the winner never
    depends on partitioning.  ``row_number() = 1`` is planned by Spark as a
    partial WindowGroupLimit before the shuffle and a final one after it, so
    a grain repeated in many loads is cut down map-side.
    """
    ordering = [F.col(c).desc_nulls_last() for c in order_by]
    ordering += [F.col(c).desc_nulls_last() for c in tiebreak]
    ordering.append(F.xxhash64(*[F.col(c) for c in df.columns]).desc())
    w = Window.partitionBy(*grain).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def top_n_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence,
                    n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group in ``order_by`` order (ascending by name)."""
    ordering = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    w = Window.partitionBy(*group).orderBy(*ordering)
    out = df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= n)
    if rank_col:
        return out.withColumnRenamed(_RN, rank_col)
    return out.drop(_RN)
