"""Staging relations: latest row per grain, typed (6 models)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import try_double
from ..functions.timeutc import to_date_strict
from ..operators.dedupe import dedupe_latest
from ..schemas import ENTITIES, INSTRUMENTS

_AREA = ["datetime", "resolution_code", "area_code", "area_name", "area_type_code",
         "area_map_code"]

# Output column order of each staging relation; measures are cast to double.
STG_COLUMNS = {
    "energy_prices": _AREA + ["contract_type", "price", "currency", "update_time"],
    "imbalance_prices": _AREA + list(INSTRUMENTS["imbalance_prices"].measures)
    + ["currency", "status", "update_time"],
    "generation_forecasts": _AREA + ["production_type"]
    + list(INSTRUMENTS["generation_forecasts"].measures) + ["update_time"],
    "aggregated_generation": _AREA + ["production_type"]
    + list(INSTRUMENTS["aggregated_generation"].measures) + ["update_time"],
}


def stg_instrument(raw: DataFrame, instrument: str, load_col: str = "load_id") -> DataFrame:
    """W1 on the instrument's grain by load id (ties: update time, row hash),
    then the typed projection (``try_cast`` of the measure texts)."""
    inst = INSTRUMENTS[instrument]
    deduped = dedupe_latest(raw, inst.grain, order_by=(load_col,), tiebreak=("update_time",))
    measures = set(inst.measures)
    cols = [try_double(c).alias(c) if c in measures else F.col(c)
            for c in STG_COLUMNS[instrument]]
    return deduped.select(*cols)


def stg_energy_prices(raw: DataFrame, **kw) -> DataFrame:
    return stg_instrument(raw, "energy_prices", **kw)


def stg_imbalance_prices(raw: DataFrame, **kw) -> DataFrame:
    return stg_instrument(raw, "imbalance_prices", **kw)


def stg_generation_forecasts(raw: DataFrame, **kw) -> DataFrame:
    return stg_instrument(raw, "generation_forecasts", **kw)


def stg_aggregated_generation(raw: DataFrame, **kw) -> DataFrame:
    return stg_instrument(raw, "aggregated_generation", **kw)


def stg_pse(raw: DataFrame, entity: str, load_col: str = "load_id") -> DataFrame:
    """PSE staging: latest per (dtime_utc, business_date), business_date as DATE."""
    ent = ENTITIES[entity]
    deduped = dedupe_latest(raw, ent.grain, order_by=(load_col,),
                            tiebreak=("publication_ts_utc",))
    return deduped.select("dtime_utc", to_date_strict("business_date").alias("business_date"),
                          *ent.measures, "publication_ts_utc")


def stg_pse_zmb(raw: DataFrame, **kw) -> DataFrame:
    return stg_pse(raw, "zmb", **kw)


def stg_pse_cor(raw: DataFrame, **kw) -> DataFrame:
    return stg_pse(raw, "cor", **kw)


STAGING = {
    "stg_energy_prices": ("energy_prices", stg_energy_prices),
    "stg_entsoe_imbalance_prices": ("imbalance_prices", stg_imbalance_prices),
    "stg_entsoe_generation_forecasts": ("generation_forecasts", stg_generation_forecasts),
    "stg_entsoe_aggregated_generation": ("aggregated_generation", stg_aggregated_generation),
    "stg_pse_zmb": ("zmb", stg_pse_zmb),
    "stg_pse_cor": ("cor", stg_pse_cor),
}
