"""The seven published marts, as DataFrame functions of staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import (forecast_category, imbalance_direction,
                                    imbalance_price_category, measure_category)
from ..operators.profile import distinct_rows  # noqa: F401 (re-exported)
from ..operators.reshape import unpivot_long
from ..schemas import (FORECAST_MEASURES, GENERATION_MEASURES, IMBALANCE_MEASURES,
                       ZMB_MEASURES)

DIM_AREA_COLUMNS = ["area_map_code", "area_code", "area_name", "area_type_code"]


def dim_area(stg_prices: DataFrame) -> DataFrame:
    """Distinct areas seen in prices, ordered by map code.

    A distinct over the whole staging relation: Spark aggregates partially
    per task first, so only a few rows per task reach the shuffle.
    """
    return distinct_rows(stg_prices, DIM_AREA_COLUMNS)


def fct_energy_prices(stg_prices: DataFrame) -> DataFrame:
    return stg_prices.select("datetime", "area_map_code", "resolution_code", "contract_type",
                             "price", "currency")


def fct_imbalance_prices(stg: DataFrame, keep_metrics=None) -> DataFrame:
    ids = ["datetime", "area_map_code", "resolution_code", "currency", "status", "update_time"]
    long = unpivot_long(stg, ids, IMBALANCE_MEASURES, "price_metric", "price",
                        keep_names=keep_metrics)
    return long.select(*ids, imbalance_direction("price_metric").alias("direction"),
                       imbalance_price_category("price_metric").alias("price_category"),
                       "price_metric", "price")


def fct_generation_forecasts(stg: DataFrame, keep_metrics=None) -> DataFrame:
    ids = ["datetime", "area_code", "area_name", "area_type_code", "area_map_code",
           "resolution_code", "production_type", "update_time"]
    long = unpivot_long(stg, ids, FORECAST_MEASURES, "forecast_metric", "forecast_mw",
                        keep_names=keep_metrics)
    return long.select(*ids, forecast_category("forecast_metric").alias("forecast_category"),
                       "forecast_metric", "forecast_mw")


def fct_aggregated_generation(stg: DataFrame, keep_metrics=None) -> DataFrame:
    ids = ["datetime", "area_code", "area_name", "area_type_code", "area_map_code",
           "resolution_code", "production_type", "update_time"]
    long = unpivot_long(stg, ids, GENERATION_MEASURES, "measure_metric", "actual_mw",
                        keep_names=keep_metrics)
    return long.select(*ids, measure_category("measure_metric").alias("measure_category"),
                       "measure_metric", "actual_mw")


def fct_pse_zmb(stg: DataFrame) -> DataFrame:
    return unpivot_long(stg, ["dtime_utc", "business_date"], ZMB_MEASURES, "product",
                        "demand_mw").select("dtime_utc", "business_date", "product", "demand_mw")


def fct_pse_cor(stg: DataFrame) -> DataFrame:
    return stg.select("dtime_utc", "business_date", "cor_cost", "cor_fcst")


# mart -> (staging model, builder, merge key or None for a full rebuild)
MARTS = {
    "dim_area": ("stg_energy_prices", dim_area, None),
    "fct_energy_prices": ("stg_energy_prices", fct_energy_prices, None),
    "fct_entsoe_imbalance_prices": (
        "stg_entsoe_imbalance_prices", fct_imbalance_prices,
        ["datetime", "resolution_code", "area_map_code", "currency", "status", "price_metric"]),
    "fct_entsoe_generation_forecasts": (
        "stg_entsoe_generation_forecasts", fct_generation_forecasts,
        ["datetime", "resolution_code", "area_code", "production_type", "forecast_metric"]),
    "fct_entsoe_aggregated_generation": (
        "stg_entsoe_aggregated_generation", fct_aggregated_generation,
        ["datetime", "resolution_code", "area_code", "production_type", "measure_metric"]),
    "fct_pse_zmb": ("stg_pse_zmb", fct_pse_zmb, None),
    "fct_pse_cor": ("stg_pse_cor", fct_pse_cor, None),
}


def with_partition_date(df: DataFrame, time_col: str, name: str = "part_date") -> DataFrame:
    """Add the date partition column used when a mart is written."""
    return df.withColumn(name, F.to_date(F.col(time_col)))
