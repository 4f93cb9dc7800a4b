"""Text scans by header name, the source's parser cases, JSON pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixture_files import fx
from gridmart.sources.pages import read_entity, read_pages
from gridmart.sources.tsv import scan_instrument, scan_tsv
from gridmart.schemas import ENTITIES, entity_row_schema


def _naive(v):
    return v.replace(tzinfo=None) if v is not None and v.tzinfo else v


def test_imbalance_parser_keeps_grain_and_utc(spark):
    (row,) = scan_instrument(spark, fx("entsoe", "imbalance"), "imbalance_prices").collect()
    assert _naive(row["datetime"]) == dt.datetime(2026, 9, 1)
    assert row["area_map_code"] == "AL"
    assert row["positive_imbalance_price"] == "69.90"
    assert row["positive_financial_neutrality_price"] == ""  # header ends in a space
    assert row["negative_imbalance_price"] == "90.78"
    assert row["update_time"] is None
    assert row["currency"] == "EUR"


def test_forecast_parser(spark):
    (row,) = scan_instrument(spark, fx("entsoe", "forecasts"), "generation_forecasts").collect()
    assert row["production_type"] == "Solar"
    assert row["day_ahead_generation_forecast_mw"] == "0.58"
    assert _naive(row["update_time"]) == dt.datetime(2026, 9, 3, 18, 20, 19)


def test_generation_parser(spark):
    (row,) = scan_instrument(spark, fx("entsoe", "generation"), "aggregated_generation").collect()
    assert row["production_type"] == "Fossil Oil"
    assert row["actual_generation_output_mw"] == "0"
    assert row["actual_consumption_mw"] == ""
    assert _naive(row["update_time"]) == dt.datetime(2026, 9, 3, 3, 20, 3)


def test_columns_matched_by_name_and_hazards(spark):
    df = scan_instrument(spark, fx("entsoe", "prices"), "energy_prices")
    rows = {(_naive(r["datetime"]), r["area_map_code"]): r for r in df.collect()}
    assert len(rows) == 7  # 3 + 1 reordered + 3 hazards (blank line skipped)
    reordered = rows[(dt.datetime(2026, 9, 2), "PL")]
    assert reordered["price"] == "120.0" and reordered["contract_type"] == "Day-ahead"
    short = rows[(dt.datetime(2026, 9, 3, 0), "CZ")]
    assert short["price"] == "" and short["currency"] == "" and short["update_time"] is None
    extra = rows[(dt.datetime(2026, 9, 3, 1), "CZ")]
    assert extra["price"] == "88.0" and extra["currency"] == "EUR"
    quoted = rows[(dt.datetime(2026, 9, 3, 2), "CZ")]
    assert quoted["area_name"] == "Czech\tia\n(CZ)" and quoted["price"] == "77.5"


def test_file_without_header_fails(spark, tmp):
    p = f"{tmp}/x.csv"
    open(p, "w").write("2026-09-01 00:00:00\tPT60M\n")
    with pytest.raises(Exception, match="file without header line"):
        scan_tsv(spark, p, ["ResolutionCode"]).collect()


def test_bad_instant_aborts(spark, tmp):
    p = f"{tmp}/bad.csv"
    open(p, "w").write("DateTime(UTC)\tUpdateTime(UTC)\n2026-09-01 00:00:00+02:00\t\n")
    with pytest.raises(Exception):
        scan_instrument(spark, p, "energy_prices").collect()


def test_pages_union_and_missing_value(spark):
    rows = read_pages(spark, fx("pse", "zmb"), entity_row_schema(ENTITIES["zmb"]))
    assert rows.count() == 9


def test_entity_timestamps_strict(spark):
    rows = read_entity(spark, fx("pse", "cor"), "cor").collect()
    assert len(rows) == 2
    assert {_naive(r["dtime_utc"]).hour for r in rows} == {0, 1}


def test_any_width_is_read_by_name(spark, tmp):
    header = ["DateTime(UTC)"] + [f"C{i}" for i in range(40)]
    with open(f"{tmp}/wide.csv", "w") as out:
        out.write("\t".join(header) + "\n" + "\t".join(["2026-09-01 00:00:00"] + [f"x{i}" for i in range(40)]) + "\n")
    row = scan_tsv(spark, f"{tmp}/wide.csv", ["C39", "C0", "none"]).first()
    assert (row["C39"], row["C0"], row["none"]) == ("x39", "x0", "")


def test_cut_off_page_fails(spark, tmp):
    schema = entity_row_schema(ENTITIES["cor"])
    with open(f"{tmp}/page.json", "w") as out:
        out.write('{"value": [{"dtime_utc": "2026-09-01 00:00:00"')
    with pytest.raises(Exception):
        read_pages(spark, f"{tmp}/page.json", schema).collect()
