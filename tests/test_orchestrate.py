"""End-to-end: landed files -> raw -> staging -> marts, and a rerun."""

import dataclasses
import os
import shutil

import pytest
from pyspark.sql import functions as F

from fixture_files import fx
from gridmart.plans import orchestrate as O
from gridmart.operators.quality import DataCheckError
from gridmart.plans import sync
from gridmart.schemas import ENTITIES, INSTRUMENTS


@pytest.fixture
def root(tmp):
    for key, sub in [("imbalance_prices", "imbalance"), ("generation_forecasts", "forecasts"),
                     ("aggregated_generation", "generation"), ("energy_prices", "prices")]:
        shutil.copytree(fx("entsoe", sub), f"{tmp}/landing/{INSTRUMENTS[key].folder}")
    shutil.copytree(fx("pse", "zmb"), f"{tmp}/landing/pse/zmb")
    shutil.copytree(fx("pse", "cor"), f"{tmp}/landing/pse/cor")
    names = [("2026_09_ImbalancePrices_17.1.G_r3.1", "2026-10-01T00:00:00"),
             ("2026_09_GenerationForecastsForWindAndSolar_14.1.D_r3", "2026-10-01T00:00:00"),
             ("2026_09_AggregatedGenerationPerType_16.1.B_C_r3", "2026-10-01T00:00:00"),
             ("2026_09_EnergyPrices_12.1.D_r3.1", "2026-10-01T00:00:00"),
             ("2026_09_02_EnergyPrices_12.1.D_r3.1", "2026-10-01T00:00:00"),
             ("2026_09_03_EnergyPrices_12.1.D_r3.1", "2026-10-01T00:00:00")]
    os.makedirs(f"{tmp}/manifest")
    with open(f"{tmp}/manifest/Export_log.csv", "w") as fh:
        fh.write("file_name\tyear\tmonth\tmax_update_time(UTC)\texport_time(UTC)\n")
        for n, u in names:
            fh.write(f"{n}\t2026\t9\t{u}\t\n")
    return tmp


def test_end_to_end_and_rerun(spark, root):
    report = O.run_entsoe(spark, root)
    assert report == {"energy_prices": 3, "imbalance_prices": 1, "generation_forecasts": 1,
                      "aggregated_generation": 1}
    assert O.run_entsoe(spark, root) == {k: 0 for k in report}  # nothing changed
    assert O.run_pse(spark, root, start="2026-09-01 00:00:00") == {"zmb": "loaded", "cor": "loaded"}
    with pytest.raises(DataCheckError, match="CZ"):  # a key of dim_area occurs twice
        O.run_models(spark, root)
    built = O.run_models(spark, root, checks=False)
    assert set(built) == {"dim_area", "fct_energy_prices", "fct_entsoe_imbalance_prices",
                          "fct_entsoe_generation_forecasts", "fct_entsoe_aggregated_generation",
                          "fct_pse_zmb", "fct_pse_cor"}
    read = lambda m: spark.read.parquet(built[m])
    assert read("fct_entsoe_imbalance_prices").count() == 2
    assert read("fct_entsoe_generation_forecasts").count() == 3
    assert read("fct_entsoe_aggregated_generation").count() == 1
    assert read("fct_energy_prices").count() == 7
    assert read("fct_pse_zmb").count() == 68
    # CZ arrives under two spellings of its name: DISTINCT keeps both rows,
    # and the declared uniqueness check on the key reports it.
    assert read("dim_area").count() == 4
    from gridmart.operators.quality import check_unique
    assert [r["area_map_code"] for r in check_unique(read("dim_area"), "area_map_code").collect()] == ["CZ"]
    # models again: the merge marts are idempotent
    O.run_models(spark, root, checks=False)
    assert read("fct_entsoe_generation_forecasts").count() == 3
    # a forced reload appends a new load; staging keeps one row per grain
    O.run_entsoe(spark, root, instruments=["imbalance_prices"], force=True)
    assert spark.read.parquet(f"{root}/raw/imbalance_prices").select("load_id").distinct().count() == 2
    O.run_models(spark, root, checks=False)
    assert read("fct_entsoe_imbalance_prices").count() == 2
    # incremental model runs give the same marts as full runs
    full = {m: sorted(map(tuple, read(m).collect()), key=str) for m in built}
    O.run_models(spark, root, checks=False, incremental=True)          # first run: everything is new
    O.run_entsoe(spark, root, instruments=["energy_prices"], force=True)
    O.run_models(spark, root, checks=False, incremental=True)          # only the reloaded prices
    assert O.run_models(spark, root, checks=False, incremental=True) == {}  # nothing new
    for m in built:
        assert sorted(map(tuple, read(m).collect()), key=str) == full[m], m
    # publish to a replica and dry-run plan
    marts = {m: spark.read.parquet(p).drop("part_date") if "part_date" in
             spark.read.parquet(p).columns else spark.read.parquet(p) for m, p in built.items()}
    plan = sync.sync_plan(marts, sync.select_tables()).collect()
    assert len(plan) == 7
    done = sync.sync_many(spark, marts, f"{root}/replica", sync.select_tables(source="pse"))
    assert [a for _, a, _ in done] == ["full-copy", "full-copy"]


def test_unknown_instrument():
    with pytest.raises(O.UnknownInstrumentError):
        O.select_instruments(["nope"])


def test_seed_records_state_without_loading(spark, root):
    assert O.run_entsoe(spark, root, seed=True)["energy_prices"] == "seeded"
    assert O.run_entsoe(spark, root) == {k: 0 for k in INSTRUMENTS}


def test_business_date_strategy_and_signature(spark, root):
    import datetime as dt
    from gridmart.schemas import Entity, ZMB_MEASURES
    heavy = {"zmb": Entity("zmb", "zmb", tuple(ZMB_MEASURES), incremental="business_date")}
    assert O.run_pse(spark, root, entities=heavy, today=dt.date(2026, 9, 9)) == {"zmb": "loaded"}
    raw = spark.read.parquet(f"{root}/raw_pse/zmb")
    assert raw.count() == 9  # 2026-09-08 is within the last 3 days of 2026-09-09
    assert sync.signature_of(spark, f"{root}/raw_pse/zmb", None) == (9, None)
    assert sync.signature_of(spark, f"{root}/nope", "ts") is None


def test_merge_by_year(spark, root, tmp):
    from gridmart.plans.export import merge_by_year
    out = merge_by_year(spark, f"{root}/landing/{INSTRUMENTS['energy_prices'].folder}",
                        "energy_prices", [2026], f"{tmp}/merged", area="PL", limit=2)
    # by name: 2026_09_02_ (1 PL row), 2026_09_03_ (none), 2026_09_Energy... (2)
    assert out == {"2026": 1}
    assert merge_by_year(spark, f"{root}/landing/{INSTRUMENTS['energy_prices'].folder}",
                         "energy_prices", [2026], f"{tmp}/merged2", area="PL") == {"2026": 3}


def test_reject_mode_keeps_good_rows(spark, root):
    folder = INSTRUMENTS["energy_prices"].folder
    with open(f"{root}/landing/{folder}/2026_09_03_EnergyPrices_12.1.D_r3.1.csv", "a") as fh:
        fh.write("2026-09-03 05:00:00+02:00\tPT60M\tX\tX\tBZN\tCZ\tDay-ahead\t1\tEUR\t\n")
    with pytest.raises(Exception):
        O.run_entsoe(spark, root, instruments=["energy_prices"])
    report = O.run_entsoe(spark, root, instruments=["energy_prices"], on_error="reject")
    assert report == {"energy_prices": 3}
    rej = spark.read.parquet(f"{root}/rejects/energy_prices").collect()
    assert [(r["field"], r["reason"]) for r in rej] == [("datetime", "non-UTC offset")]
    assert spark.read.parquet(f"{root}/raw/energy_prices").count() == 7


def test_unlanded_files_are_reported_or_fail(spark, root):
    with open(f"{root}/manifest/Export_log.csv", "a") as fh:
        fh.write("2026_10_EnergyPrices_12.1.D_r3.1\t2026\t10\t2026-11-01T00:00:00\t\n")
    with pytest.raises(O.UnlandedFilesError, match="2026_10_"):
        O.run_entsoe(spark, root, instruments=["energy_prices"],
                     selected_files=["2026_10_EnergyPrices_12.1.D_r3.1.csv", "2026_09_EnergyPrices_12.1.D_r3.1.csv"])
    assert O.run_entsoe(spark, root, instruments=["energy_prices"]) == {"energy_prices": 3, "energy_prices:unlanded": 1}


def test_ingest_precedence_and_chain(spark, root):
    report = O.run_ingest(spark, root, sources=["pse"], date="2026-09-08", from_date="2026-01-01")
    assert report == {"pse": {"zmb": "loaded", "cor": "loaded"}}
    days = spark.read.parquet(f"{root}/raw_pse/zmb").select("business_date").distinct().collect()
    assert [str(r[0])[:10] for r in days] == ["2026-09-08"]
    with pytest.raises(ValueError, match="nope"):
        O.run_ingest(spark, root, sources=["nope"])
    done = O.run_all(spark, root, f"{root}/replica", checks=False, sources=["entsoe"])
    assert {t for t, *_ in done["sync"]} >= {"fct_energy_prices", "dim_area", "fct_pse_zmb"}


def test_publication_increment_reads_new_pages_only(spark, root):
    import datetime as dt
    now = dt.datetime(2026, 9, 2, tzinfo=dt.timezone.utc)
    assert O.run_pse(spark, root) == {"zmb": "no baseline", "cor": "no baseline"}
    O.run_ingest(spark, root, sources=["pse"], backfill_days=30, now=now)
    first = spark.read.parquet(f"{root}/raw_pse/zmb").count()
    assert first == 9 and O.run_pse(spark, root) == {"zmb": "nothing new", "cor": "nothing new"}


def test_renamed_area_goes_in_an_incremental_run(spark, root):
    O.run_entsoe(spark, root, instruments=["energy_prices"])
    O.run_models(spark, root, checks=False, incremental=True)
    path = f"{root}/landing/{INSTRUMENTS['energy_prices'].folder}/2026_09_03_EnergyPrices_12.1.D_r3.1.csv"
    text = open(path).read()
    old = next(r["area_name"] for r in spark.read.parquet(f"{root}/marts/dim_area").collect()
               if r["area_map_code"] == "CZ" and r["area_name"] in text)
    open(path, "w").write(text.replace(old, "Renamed"))
    O.run_entsoe(spark, root, instruments=["energy_prices"], force=True)
    O.run_models(spark, root, checks=False, incremental=True)
    part = {tuple(r) for r in spark.read.parquet(f"{root}/marts/dim_area").collect()}
    O.run_models(spark, root, checks=False)
    assert part == {tuple(r) for r in spark.read.parquet(f"{root}/marts/dim_area").collect()}


def test_a_failed_entity_is_skipped_with_its_state(spark, root):
    bad = f"{root}/landing/pse/zmb/cut.json"
    with open(bad, "w") as out:
        out.write('{"value": [{"dtime_utc": "2026-09-01')
    with pytest.raises(Exception):
        O.run_pse(spark, root, start="2026-09-01 00:00:00")
    report = O.run_pse(spark, root, start="2026-09-01 00:00:00", on_error="skip")
    assert report["cor"] == "loaded" and report["zmb"].startswith("failed")
    assert not os.path.exists(f"{root}/state/pse/zmb") and os.path.exists(f"{root}/state/pse/cor")
    os.remove(bad)
    assert O.run_pse(spark, root, start="2026-09-01 00:00:00")["zmb"] == "loaded"
    assert spark.read.parquet(f"{root}/raw_pse/zmb").count() == 9
    with pytest.raises(ValueError, match="on_error"):
        O.run_pse(spark, root, on_error="ignore")


def test_days_read_only_the_pages_that_hold_them(spark, root, monkeypatch):
    heavy = {"cor": dataclasses.replace(ENTITIES["cor"], incremental="business_date")}
    row = '{"dtime_utc": "%s 00:00:00", "business_date": "%s", "cor_cost": 1, "cor_fcst": 2, "publication_ts_utc": "%s 01:00:00"}'
    for name, days in (("a+b.json", ["2026-07-01", "2026-07-03"]), ("c d.json", ["2026-07-04"]), ("none.json", [])):
        with open(f"{root}/landing/pse/cor/{name}", "w") as out:
            out.write('{"value": [%s]}' % ", ".join(row % (d, d, d) for d in days))
    read = []
    real = O.read_entity
    monkeypatch.setattr(O, "read_entity", lambda s, paths, *a, **k: read.append(sorted(p.rsplit("/", 1)[1] for p in paths)) or real(s, paths, *a, **k))

    def run(*days):
        read.clear()
        return O.run_pse(spark, root, dates=list(days), entities=heavy)["cor"], list(read)

    assert run("2026-07-03", "2026-07-04") == ("loaded", [["a+b.json", "c d.json", "c1.json", "none.json"], ["a+b.json", "c d.json"]])
    assert run("2026-07-04") == ("loaded", [["c d.json"]])
    assert run("2026-08-04") == ("nothing of these days", [])
    assert spark.read.parquet(f"{root}/raw_pse/cor").count() == 3
