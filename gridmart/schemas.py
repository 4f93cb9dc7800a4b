"""Table schemas, grains and the source registries.

Types are fixed per table; schema inference is never used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's, stated as they appear.
# ENTSO-E file library: instrument folder names and the text header of each
# column we read.  The header of the positive financial-neutrality price ends
# in a space in the published files; headers are trimmed before matching.
# ---------------------------------------------------------------------------
COMMON_HEADERS = {
    "DateTime(UTC)": "datetime",
    "ResolutionCode": "resolution_code",
    "AreaCode": "area_code",
    "AreaDisplayName": "area_name",
    "AreaTypeCode": "area_type_code",
    "AreaMapCode": "area_map_code",
}
UPDATE_TIME_HEADER = "UpdateTime(UTC)"
DATETIME_HEADER = "DateTime(UTC)"

ENERGY_PRICE_HEADERS = {
    "ContractType": "contract_type",
    "Price[Currency/MWh]": "price",
    "Currency": "currency",
}
IMBALANCE_HEADERS = {
    "Currency": "currency",
    "Status": "status",
    "PositiveImbalancePrice[Currency/MWh]": "positive_imbalance_price",
    "PositiveScarcity[Currency/MWh]": "positive_scarcity_price",
    "PositiveIncentive[Currency/MWh]": "positive_incentive_price",
    "PositiveFinancialNeutrality[Currency/MWh]": "positive_financial_neutrality_price",
    "NegativeImbalancePrice[Currency/MWh]": "negative_imbalance_price",
    "NegativeScarcity[Currency/MWh]": "negative_scarcity_price",
    "NegativeIncentive[Currency/MWh]": "negative_incentive_price",
    "NegativeFinancialNeutrality[Currency/MWh]": "negative_financial_neutrality_price",
}
FORECAST_HEADERS = {
    "ProductionType": "production_type",
    "DayAheadGenerationForecast[MW]": "day_ahead_generation_forecast_mw",
    "IntradayGenerationForecast[MW]": "intraday_generation_forecast_mw",
    "CurrentGenerationForecast[MW]": "current_generation_forecast_mw",
}
GENERATION_HEADERS = {
    "ProductionType": "production_type",
    "ActualGenerationOutput[MW]": "actual_generation_output_mw",
    "ActualConsumption[MW]": "actual_consumption_mw",
}

# The measure columns of each table.
IMBALANCE_MEASURES = [
    "positive_imbalance_price",
    "positive_scarcity_price",
    "positive_incentive_price",
    "positive_financial_neutrality_price",
    "negative_imbalance_price",
    "negative_scarcity_price",
    "negative_incentive_price",
    "negative_financial_neutrality_price",
]
FORECAST_MEASURES = [
    "day_ahead_generation_forecast_mw",
    "intraday_generation_forecast_mw",
    "current_generation_forecast_mw",
]
GENERATION_MEASURES = ["actual_generation_output_mw", "actual_consumption_mw"]
ZMB_MEASURES = ["zmb_fcrg", "zmb_fcrd", "zmb_frrg", "zmb_frrd",
                "zmb_afrrg", "zmb_afrrd", "zmb_rrg", "zmb_rrd"]
COR_MEASURES = ["cor_cost", "cor_fcst"]


@dataclass(frozen=True)
class Instrument:
    """One ENTSO-E instrument: where its files live and how they map."""

    key: str
    folder: str
    resource: str
    headers: dict
    grain: tuple
    measures: tuple
    enabled: bool = True


# Folder names of the four instruments in the file library.
INSTRUMENTS = {
    "energy_prices": Instrument(
        "energy_prices", "EnergyPrices_12.1.D_r3.1", "energy_prices",
        ENERGY_PRICE_HEADERS,
        ("datetime", "resolution_code", "area_map_code", "contract_type"),
        ("price",)),
    "imbalance_prices": Instrument(
        "imbalance_prices", "ImbalancePrices_17.1.G_r3.1", "imbalance_prices",
        IMBALANCE_HEADERS,
        ("datetime", "resolution_code", "area_map_code", "currency", "status"),
        tuple(IMBALANCE_MEASURES)),
    "generation_forecasts": Instrument(
        "generation_forecasts", "GenerationForecastsForWindAndSolar_14.1.D_r3",
        "generation_forecasts", FORECAST_HEADERS,
        ("datetime", "resolution_code", "area_code", "production_type"),
        tuple(FORECAST_MEASURES)),
    "aggregated_generation": Instrument(
        "aggregated_generation", "AggregatedGenerationPerType_16.1.B_C_r3",
        "aggregated_generation", GENERATION_HEADERS,
        ("datetime", "resolution_code", "area_code", "production_type"),
        tuple(GENERATION_MEASURES)),
}


def raw_columns(instrument: Instrument) -> list[str]:
    """Output column order of a raw table (text except the two instants)."""
    cols = list(COMMON_HEADERS.values())
    cols += [c for c in instrument.headers.values()]
    cols.append("update_time")
    return cols


@dataclass(frozen=True)
class Entity:
    """One PSE entity: measures, timestamp columns and increment strategy."""

    key: str
    endpoint: str
    measures: tuple
    incremental: str = "publication_ts_utc"
    timestamp_columns: tuple = ("dtime_utc", "publication_ts_utc")
    grain: tuple = ("dtime_utc", "business_date")


# The entities and their endpoints.
ENTITIES = {
    "zmb": Entity("zmb", "zmb", tuple(ZMB_MEASURES)),
    "cor": Entity("cor", "cor", tuple(COR_MEASURES)),
}


def entity_row_schema(entity: Entity) -> T.StructType:
    """JSON row schema of one page entry; timestamps arrive as text."""
    fields = [T.StructField("dtime_utc", T.StringType()),
              T.StructField("business_date", T.StringType())]
    fields += [T.StructField(m, T.DoubleType()) for m in entity.measures]
    fields.append(T.StructField("publication_ts_utc", T.StringType()))
    return T.StructType(fields)


def page_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("value", T.ArrayType(row_schema)),
        T.StructField("nextLink", T.StringType()),
    ])


# Published tables, their time column (None: replaced whole) and source group.
@dataclass(frozen=True)
class Published:
    name: str
    time_column: str | None
    source: str
    unique_key: tuple = field(default=())


# The published tables, their time columns and unique keys.
PUBLISHED = {
    "dim_area": Published("dim_area", None, "entsoe", ("area_map_code",)),
    "fct_energy_prices": Published(
        "fct_energy_prices", "datetime", "entsoe",
        ("datetime", "resolution_code", "area_map_code", "contract_type")),
    "fct_entsoe_imbalance_prices": Published(
        "fct_entsoe_imbalance_prices", "datetime", "entsoe",
        ("datetime", "resolution_code", "area_map_code", "currency", "status",
         "price_metric")),
    "fct_entsoe_generation_forecasts": Published(
        "fct_entsoe_generation_forecasts", "datetime", "entsoe",
        ("datetime", "resolution_code", "area_code", "production_type",
         "forecast_metric")),
    "fct_entsoe_aggregated_generation": Published(
        "fct_entsoe_aggregated_generation", "datetime", "entsoe",
        ("datetime", "resolution_code", "area_code", "production_type",
         "measure_metric")),
    "fct_pse_zmb": Published("fct_pse_zmb", "dtime_utc", "pse",
                             ("dtime_utc", "business_date", "product")),
    "fct_pse_cor": Published("fct_pse_cor", "dtime_utc", "pse",
                             ("dtime_utc", "business_date")),
}

MANIFEST_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("updated", T.StringType()),
])
STATE_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("updated", T.StringType()),
])
WATERMARK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("remote_max", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])
