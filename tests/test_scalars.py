"""Numeric text, file-name algebra and category columns."""

import math

import pytest
from pyspark.sql import functions as F

from gridmart.functions import (filename_to_folder, forecast_category, imbalance_direction,
                                imbalance_price_category, measure_category,
                                normalize_filename, text_or_empty, to_date_strict,
                                try_double)

CASES = [("", None), (" 1.5 ", 1.5), ("1,5", None), ("NaN", "nan"), ("inf", math.inf),
         ("-Infinity", -math.inf), ("1e3", 1000.0), ("1d", None), ("1e3f", None),
         ("0x1p3", None), ("1_000", None), ("+1", 1.0), (".5", 0.5), ("5.", 5.0),
         ("-", None), ("n/e", None), ("1 000", None), (None, None)]


def test_try_double(spark):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "s string")
    got = [r[0] for r in df.select(try_double("s")).collect()]
    for (s, want), g in zip(CASES, got):
        if want == "nan":
            assert g is not None and math.isnan(g), s
        else:
            assert g == want, s


def test_text_or_empty_strips_unicode_space(spark):
    df = spark.createDataFrame([(None,), ("\t a ",), ("b",)], "s string")
    assert [r[0] for r in df.select(text_or_empty("s")).collect()] == ["", "a", "b"]


@pytest.mark.parametrize("name,folder,norm", [
    ("2026_07_ImbalancePrices_17.1.G_r3.1", "ImbalancePrices_17.1.G_r3.1",
     "2026_07_ImbalancePrices_17.1.G_r3.1.csv"),
    ("2026_07_01_ImbalancePrices_17.1.G_r3.1.CSV", "ImbalancePrices_17.1.G_r3.1",
     "2026_07_01_ImbalancePrices_17.1.G_r3.1.CSV"),
    ("Export.csv", "Export", "Export.csv"),
])
def test_file_names(spark, name, folder, norm):
    r = spark.createDataFrame([(name,)], "s string").select(
        filename_to_folder("s"), normalize_filename("s")).collect()[0]
    assert (r[0], r[1]) == (folder, norm)


def test_categories(spark):
    names = ["positive_imbalance_price", "negative_financial_neutrality_price", "other"]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = [tuple(r) for r in df.select(imbalance_direction("m"),
                                       imbalance_price_category("m")).collect()]
    assert got == [("positive", "imbalance"), ("negative", "financial_neutrality"),
                   (None, None)]
    df2 = spark.createDataFrame([("day_ahead_generation_forecast_mw",),
                                 ("intraday_generation_forecast_mw",), ("x",)], "m string")
    assert [r[0] for r in df2.select(forecast_category("m")).collect()] == \
        ["day_ahead", "intraday", "current"]
    df3 = spark.createDataFrame([("actual_generation_output_mw",), ("y",)], "m string")
    assert [r[0] for r in df3.select(measure_category("m")).collect()] == \
        ["generation_output", "consumption"]


def test_to_date_strict(spark):
    ok = spark.createDataFrame([("2026-09-08",)], "s string").select(to_date_strict("s"))
    assert str(ok.collect()[0][0]) == "2026-09-08"
    with pytest.raises(Exception):
        spark.createDataFrame([("2026",)], "s string").select(to_date_strict("s")).collect()
