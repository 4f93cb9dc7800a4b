"""Declared metrics by dimension.

The semantic model is plain data: per mart, the measure column, its metrics
and the dimension join.  A metric query is one join + filter + groupBy + agg.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import join_dim


@dataclass(frozen=True)
class Metric:
    name: str
    column: str
    kind: str  # average | max | min | sum | count


@dataclass(frozen=True)
class Model:
    name: str
    metrics: tuple
    time_dimensions: Mapping = field(default_factory=dict)
    join_on: str | None = None  # column joined to dim_area


def _m(model_col, *pairs):
    return tuple(Metric(n, model_col, k) for n, k in pairs)


# Declared metrics of the published marts (name, column, type).
MODELS = {
    "fct_energy_prices": Model(
        "fct_energy_prices",
        _m("price", ("average_price", "average"), ("max_price", "max"), ("min_price", "min")),
        {"datetime": "timestamp"}, "area_map_code"),
    "fct_entsoe_generation_forecasts": Model(
        "fct_entsoe_generation_forecasts",
        _m("forecast_mw", ("average_forecast_mw", "average"), ("max_forecast_mw", "max"),
           ("total_forecast_mw", "sum")),
        {"datetime": "timestamp"}, "area_code"),
    "fct_pse_zmb": Model(
        "fct_pse_zmb",
        _m("demand_mw", ("total_demand_mw", "sum"), ("average_demand_mw", "average"),
           ("max_demand_mw", "max")),
        {"dtime_utc": "timestamp", "business_date": "date"}),
    "fct_pse_cor": Model(
        "fct_pse_cor",
        _m("cor_cost", ("average_cor_cost", "average"), ("max_cor_cost", "max"))
        + _m("cor_fcst", ("average_cor_fcst", "average"), ("max_cor_fcst", "max")),
        {"dtime_utc": "timestamp", "business_date": "date"}),
    "fct_entsoe_imbalance_prices": Model(
        "fct_entsoe_imbalance_prices",
        _m("price", ("average_imbalance_price", "average"), ("max_imbalance_price", "max"),
           ("min_imbalance_price", "min")),
        {"datetime": "timestamp"}, "area_map_code"),
    "fct_entsoe_aggregated_generation": Model(
        "fct_entsoe_aggregated_generation",
        _m("actual_mw", ("average_actual_mw", "average"), ("max_actual_mw", "max"),
           ("total_actual_mw", "sum")),
        {"datetime": "timestamp"}, "area_code"),
}

_AGG = {"average": F.avg, "max": F.max, "min": F.min, "sum": F.sum,
        "count": F.count}


def metric_column(metric: Metric, round_to: int | None = None) -> Column:
    col = _AGG[metric.kind](F.col(metric.column))
    if round_to is not None and metric.kind in ("average", "sum"):
        col = F.round(col, round_to)
    return col.alias(metric.name)


def metric_query(fact: DataFrame, model: str | Model, dims: Sequence = (),
                 metrics: Sequence[str] | None = None, filters: Column | None = None,
                 dim_area: DataFrame | None = None, how: str = "left",
                 grain: Mapping[str, str] | None = None,
                 order: Sequence[str] | None = None, limit: int | None = None,
                 round_to: int | None = None, with_count: bool = False) -> DataFrame:
    """Group a mart by dimensions and compute declared metrics.

    ``grain`` maps a time dimension to a ``date_trunc`` unit.  ``dim_area``
    joins the area dimension on the model's key (checked-size broadcast).
    """
    m = MODELS[model] if isinstance(model, str) else model
    chosen = [x for x in m.metrics if metrics is None or x.name in metrics]
    if metrics is not None:
        unknown = sorted(set(metrics) - {x.name for x in m.metrics})
        if unknown:
            raise KeyError(f"unknown metrics for {m.name}: {', '.join(unknown)}")
    df = fact
    if dim_area is not None and m.join_on:
        df = join_dim(df, dim_area, m.join_on, how=how)
    if filters is not None:
        df = df.where(filters)
    group_cols = []
    for d in dims:
        if isinstance(d, Column):
            group_cols.append(d)
        elif grain and d in grain:
            group_cols.append(F.date_trunc(grain[d], F.col(d)).alias(d))
        else:
            group_cols.append(F.col(d))
    dim_names = [d for d in dims if isinstance(d, str)]
    if (any(x.kind == "sum" for x in chosen) and "resolution_code" in df.columns
            and "resolution_code" not in dim_names and "resolution_code" not in str(filters)):
        warnings.warn("summing megawatts across mixed resolutions: group or filter "
                      "resolution_code", stacklevel=2)
    aggs = [metric_column(x, round_to) for x in chosen]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("row_count"))
    out = df.groupBy(*group_cols).agg(*aggs)
    if order:
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    if limit is not None:
        out = out.limit(limit)
    return out


def adhoc_sql(spark: SparkSession, marts: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Free SQL over the marts registered as temporary views."""
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
