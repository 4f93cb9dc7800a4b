"""Staging dedupe and long marts: expected rows from the source's samples."""

import datetime as dt

from pyspark.sql import functions as F

from fixture_files import fx
from gridmart.operators.dedupe import dedupe_latest
from gridmart.plans import marts, staging
from gridmart.sources.pages import read_entity
from gridmart.sources.tsv import scan_instrument


def raw(spark, folder, inst, load_id=1):
    return scan_instrument(spark, fx("entsoe", folder), inst).drop("file_path") \
        .withColumn("load_id", F.lit(load_id).cast("bigint"))


def test_imbalance_long_rows(spark):
    stg = staging.stg_imbalance_prices(raw(spark, "imbalance", "imbalance_prices"))
    rows = {(r["direction"], r["price_category"]): r["price"]
            for r in marts.fct_imbalance_prices(stg).collect()}
    assert rows == {("positive", "imbalance"): 69.9, ("negative", "imbalance"): 90.78}


def test_forecast_and_generation_long_rows(spark):
    f = marts.fct_generation_forecasts(staging.stg_generation_forecasts(
        raw(spark, "forecasts", "generation_forecasts")))
    assert sorted(r["forecast_category"] for r in f.collect()) == ["current", "day_ahead", "intraday"]
    g = marts.fct_aggregated_generation(staging.stg_aggregated_generation(
        raw(spark, "generation", "aggregated_generation"))).collect()
    assert [(r["measure_category"], r["actual_mw"]) for r in g] == [("generation_output", 0.0)]


def test_latest_load_wins_and_partitioning_independent(spark):
    a = raw(spark, "prices", "energy_prices", 1)
    b = raw(spark, "prices", "energy_prices", 2).withColumn("currency", F.lit("PLN"))
    both = a.unionByName(b)
    stg = staging.stg_energy_prices(both)
    assert {r["currency"] for r in stg.collect()} == {"PLN"}
    one = sorted(map(tuple, staging.stg_energy_prices(both.repartition(1)).collect()))
    seven = sorted(map(tuple, staging.stg_energy_prices(both.repartition(7)).collect()))
    assert one == seven
    # idempotent
    assert dedupe_latest(stg.withColumn("load_id", F.lit(1)), ["datetime", "resolution_code",
                         "area_map_code", "contract_type"]).count() == stg.count()


def test_ties_in_one_load_are_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 5, "c")], "g int, load_id int, v string")
    winners = {dedupe_latest(df.repartition(n), ["g"]).collect()[0]["v"] for n in (1, 2, 3, 5)}
    assert len(winners) == 1


def test_dim_area_and_prices(spark):
    stg = staging.stg_energy_prices(raw(spark, "prices", "energy_prices"))
    dim = marts.dim_area(stg).collect()
    assert [r["area_map_code"] for r in dim] == ["CZ", "CZ", "DE", "PL"]  # CZ under two names
    prices = {r["price"] for r in marts.fct_energy_prices(stg).collect()}
    assert None in prices and 101.5 in prices  # 'n/e' and '' became NULL


def test_pse_shapes(spark):
    z = read_entity(spark, fx("pse", "zmb"), "zmb").withColumn("load_id", F.lit(1))
    stg = staging.stg_pse_zmb(z)
    assert stg.count() == 9
    long = marts.fct_pse_zmb(stg)
    assert long.count() == 9 * 8 - 4  # one row has four NULL measures
    c = read_entity(spark, fx("pse", "cor"), "cor").withColumn("load_id", F.lit(1))
    cor = marts.fct_pse_cor(staging.stg_pse_cor(c))
    assert cor.count() == 2
    assert isinstance(cor.collect()[0]["business_date"], dt.date)


def test_unpivot_keep_names_narrows(spark):
    stg = staging.stg_imbalance_prices(raw(spark, "imbalance", "imbalance_prices"))
    only = marts.fct_imbalance_prices(stg, keep_metrics=["negative_imbalance_price"]).collect()
    assert [r["price"] for r in only] == [90.78]
