"""Yearly CSV export, monthly merge by name, load progress from logs."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from fixture_files import fx
from gridmart.operators import audit
from gridmart.plans.export import (UnknownTableError, counts_by_year, export_csv_by_year,
                                   merge_monthly_tsv)


def test_export_by_year(spark, tmp):
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 23), 1.0), (dt.datetime(2026, 1, 1), 2.0),
                                (dt.datetime(2026, 6, 1), 3.0)], "datetime timestamp, price double")
    counts = export_csv_by_year({"fct_energy_prices": df, "fct_pse_cor": None}, [2025, 2026], tmp,
                                known=["fct_energy_prices", "fct_pse_cor"], one_file=True)
    got = {(r["table_name"], r["year"]): r["row_count"] for r in counts.collect()}
    assert got == {("fct_energy_prices", 2025): 1, ("fct_energy_prices", 2026): 2}
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{tmp}/fct_energy_prices_2026.csv/*.csv")))
    lines = text.strip().splitlines()
    assert lines[0] == "datetime,price" and lines[1].startswith("2026-01-01 00:00:00+00")
    with pytest.raises(UnknownTableError):
        export_csv_by_year({"nope": df}, [2026], tmp, known=["fct_energy_prices"])


def test_counts_by_year(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 5, 1),)], "t timestamp_ntz")
    got = {r["year"]: r["row_count"] for r in counts_by_year(df, "t", [2024, 2025]).collect()}
    assert got == {2024: 0, 2025: 1}


def test_merge_monthly_by_name(spark, tmp):
    n = merge_monthly_tsv(spark, fx("entsoe", "prices"), f"{tmp}/energy_prices_2026_PL.csv", area="PL")
    assert n == 3
    n_all = merge_monthly_tsv(spark, fx("entsoe", "prices"), f"{tmp}/energy_prices_2026.csv")
    assert n_all == 7
    back = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp}/energy_prices_2026_PL.csv")
    assert {r["Price[Currency/MWh]"] for r in back.collect()} == {"101.5", "99.25", "120.0"}


def test_load_progress(spark):
    lines = audit.read_log(spark, fx("backfill.log"))
    prog = {r["resource"]: r for r in audit.load_progress(audit.parse_events(lines),
                                                          audit.expected_frame(spark)).collect()}
    assert set(prog) == {"imbalance_prices", "generation_forecasts", "aggregated_generation"}
    imb = prog["imbalance_prices"]
    assert (imb["started"], imb["done"], imb["rows"]) == (2, 1, 123)
    assert imb["last_file"] == "2025_02_ImbalancePrices_17.1.G_r3.1.csv"
    assert prog["aggregated_generation"]["started"] == 0
    t0 = audit.run_start(lines).collect()[0]["t0"]
    assert t0 == "2026-09-11 10:00:00"


def test_summary_lines(spark):
    lines = audit.read_log(spark, fx("backfill.log"))
    prog = audit.load_progress(audit.parse_events(lines), audit.expected_frame(spark))
    totals = audit.load_totals(audit.parse_events(lines), audit.expected_frame(spark), audit.run_start(lines),
                               dt.datetime(2026, 9, 11, 10, 2))
    t = totals.first()
    # energy_prices, of which no file is expected, counts as begun too
    assert (t["expected"], t["started"], t["files_per_minute"]) == (63, 4, 2.0)
    assert t["minutes_left"] == pytest.approx(29.5)
    out = audit.status_lines(prog, totals)
    assert any(line.startswith("imbalance_prices: 2 of 21 files begun, 1 finished, 123 rows") for line in out)
    assert out[-1] == "pace 2.0 files a minute, 30 minutes to go"


def test_quality_report(spark):
    from gridmart.operators.quality import quality_report
    dim = spark.createDataFrame([("PL", "a"), ("PL", "b"), (None, "c")],
                                "area_map_code string, area_code string")
    got = {(r["test"], r["failures"]) for r in quality_report({"dim_area": dim}).collect()}
    assert got == {("unique", 1), ("not_null", 1)}


def test_mirror_stages_only_a_self_read(spark, tmp):
    from pyspark.sql import functions as F
    from gridmart.plans.export import mirror_table
    from gridmart.session import reads_path
    target = f"{tmp}/mirror"
    src = spark.range(100).withColumn("v", F.col("id") * 2)
    assert not reads_path(src, target)  # missing target
    mirror_table(src, target)
    first = spark.read.parquet(target)
    assert first.count() == 100
    assert reads_path(first, target) and reads_path(first, "file:" + target)
    assert not reads_path(src, target)
    assert not reads_path(first, target + "-other")
    # a refresh computed from the target itself is staged, so it survives
    mirror_table(first.where("id < 40").withColumn("v", F.col("v") + 1), target)
    out = spark.read.parquet(target)
    assert out.count() == 40 and out.agg(F.sum("v")).first()[0] == sum(2 * i + 1 for i in range(40))
