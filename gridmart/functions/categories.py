"""Derived category columns of the long marts (LIKE / equality CASEs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def like_case(c, cases, default=None) -> Column:
    """CASE WHEN c LIKE p1 THEN v1 ... [ELSE default] END (first match wins)."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for pattern, value in cases:
        cond = c.like(pattern)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if default is not None:
        out = out.otherwise(F.lit(default))
    return out


# LIKE patterns and labels of the imbalance price metrics.
DIRECTION_CASES = [
    ("positive_%", "positive"),
    ("negative_%", "negative"),
]
PRICE_CATEGORY_CASES = [
    ("%_imbalance_price", "imbalance"),
    ("%_scarcity_price", "scarcity"),
    ("%_incentive_price", "incentive"),
    ("%_financial_neutrality_price", "financial_neutrality"),
]


def imbalance_direction(c) -> Column:
    """positive / negative from the metric name; no match gives NULL."""
    return like_case(c, DIRECTION_CASES)


def imbalance_price_category(c) -> Column:
    return like_case(c, PRICE_CATEGORY_CASES)


def forecast_category(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c == "day_ahead_generation_forecast_mw", "day_ahead")
            .when(c == "intraday_generation_forecast_mw", "intraday")
            .otherwise("current"))


def measure_category(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "actual_generation_output_mw", "generation_output").otherwise("consumption")
