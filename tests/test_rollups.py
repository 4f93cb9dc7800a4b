"""Rollup store: answers equal the direct metric query, from states that follow the mart."""

import datetime as dt
import glob
import random

import pytest
from fixture_files import spoil
from pyspark.sql import functions as F

from gridmart.operators.metrics import MODELS, metric_query
from gridmart.operators.upsert import write_partitions
from gridmart.plans.rollups import ROLLUPS, NoRollupError, Rollup, RollupStore
from gridmart.session import delete_path

D = dt.date
PRICES = "fct_energy_prices"


def prices(spark, seed, days):
    rng = random.Random(seed)
    rows = [(dt.datetime(2026, m, d, rng.randrange(24)), rng.choice(["PL", "DE", None]), rng.choice(["PT15M", "PT60M"]),
             rng.choice(["Day-ahead", "Intraday"]), rng.choice([None, float(rng.randrange(-50, 400))]), "EUR")
            for m, d in days for _ in range(12)]
    df = spark.createDataFrame(rows, "datetime timestamp, area_map_code string, resolution_code string, contract_type string, "
                                     "price double, currency string")
    return df.withColumn("part_date", F.to_date("datetime"))


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture
def store(spark, tmp):
    path = f"{tmp}/mart"
    write_partitions(prices(spark, 1, [(m, d) for m in (1, 2, 3) for d in (1, 2, 28)]), path, "part_date", "static")
    made = RollupStore(spark, f"{tmp}/rollups", PRICES)
    made.refresh(path)
    return made, path


#: dimensions, filters, days, unit -> the rollup that answers
QUESTIONS = [
    ((), None, None, None, "month_total"),
    (("resolution_code",), {"resolution_code": ["PT15M"]}, (D(2026, 2, 1), None), "month", "month_total"),
    (("area_map_code",), {"resolution_code": ["PT60M"]}, None, "quarter", "month_area"),
    (("area_map_code",), None, (D(2026, 1, 2), D(2026, 3, 2)), "month", "day_all"),
    (("contract_type", "area_map_code"), {"currency": ["EUR"]}, None, "day", "day_all"),
    ((), None, (D(2026, 1, 1), D(2026, 3, 1)), "week", "day_all"),
    (("area_map_code",), {"area_map_code": ["none"]}, None, "year", "month_area"),
    ((), {"area_map_code": ["none"]}, None, None, "month_area"),
]


def direct(spark, path, dims, where, between, unit):
    fact = spark.read.parquet(path)
    for name, values in (where or {}).items():
        fact = fact.where(F.col(name).isin(values))
    low, high = between or (None, None)
    if low:
        fact = fact.where(F.col("datetime") >= F.lit(low))
    if high:
        fact = fact.where(F.col("datetime") < F.lit(high))
    return metric_query(fact, PRICES, [*dims, *(["datetime"] if unit else [])], grain={"datetime": unit} if unit else None, with_count=True)


@pytest.mark.filterwarnings("ignore:summing")
def test_answers_equal_the_direct_query_also_after_changes(spark, store):
    made, path = store

    def compare():
        for dims, where, between, unit, name in QUESTIONS:
            assert made.choose(dims, where, unit, between).name == name
            got = made.answer(dims, None, where, between, unit, with_count=True)
            assert rows_of(got) == rows_of(direct(spark, path, dims, where, between, unit)), (dims, where, unit)
            assert got.inputFiles() and all("/rollups/" in f for f in got.inputFiles())

    compare()
    write_partitions(prices(spark, 2, [(2, 2), (4, 7)]), path, "part_date")
    delete_path(spark, f"{path}/part_date=2026-03-28")
    for d in (1, 2, 28):
        delete_path(spark, f"{path}/part_date=2026-01-{d:02d}")  # a month goes
    assert made.refresh(path) == ["2026-01-01", "2026-01-02", "2026-01-28", "2026-02-02", "2026-03-28", "2026-04-07"]
    compare()
    assert made.refresh(path) == []


def test_only_changed_days_are_read(spark, store):
    made, path = store
    for name in glob.glob(f"{path}/part_date=2026-0[13]-*"):
        spoil(name)
    write_partitions(prices(spark, 3, [(2, 1)]), path, "part_date")
    assert made.refresh(path) == ["2026-02-01"]
    assert made.answer((), unit="month").count() == 3


def test_queries_that_no_rollup_fits(spark, store):
    made, path = store
    fact = spark.read.parquet(path)
    at = dt.datetime(2026, 2, 1, 12)
    assert made.choose((), None, None, (at, None)) is None and made.choose(("price",)) is None and made.choose((), unit="hour") is None
    with pytest.raises(NoRollupError):
        made.answer((), unit="hour")
    got = made.answer(("area_map_code",), between=(at, None), unit="hour", fact=fact, with_count=True)
    want = metric_query(fact.where(F.col("datetime") >= F.lit(at)), PRICES, ["area_map_code", "datetime"], grain={"datetime": "hour"}, with_count=True)
    assert rows_of(got) == rows_of(want)
    with pytest.raises(KeyError, match="nothing"):
        made.answer((), ["nothing"])


def test_area_dimension_is_joined_to_the_states(spark, store):
    made, path = store
    dim = spark.createDataFrame([("PL", "Poland", "CTA"), ("DE", "Germany", "CTA"), ("DE", "Deutschland", "BZN")],
                                "area_map_code string, area_name string, area_type_code string")
    got = made.answer((), ["average_price", "max_price"], unit="month", dim_area=dim, area_dims=["area_type_code"], with_count=True)
    want = metric_query(spark.read.parquet(path), PRICES, ["area_type_code", "datetime"], ["average_price", "max_price"],
                        dim_area=dim, grain={"datetime": "month"}, with_count=True)
    assert rows_of(got) == rows_of(want)
    assert made.choose((), keys=["area_map_code"]).name == "month_area"


def test_undated_rows_and_empty_marts(spark, tmp):
    path, made = f"{tmp}/mart", RollupStore(spark, f"{tmp}/r", "fct_pse_cor")
    assert made.refresh(path) == []
    rows = spark.createDataFrame([(None, D(2026, 1, 1), 1.0, None), (dt.datetime(2026, 1, 1), D(2026, 1, 1), None, None)],
                                 "dtime_utc timestamp, business_date date, cor_cost double, cor_fcst double")
    write_partitions(rows.withColumn("part_date", F.to_date("dtime_utc")), path, "part_date")
    made.refresh(path)
    got = made.answer((), with_count=True).first()
    assert (got["row_count"], got["average_cor_cost"], got["max_cor_fcst"], got["average_cor_fcst"]) == (2, 1.0, None, None)
    assert sorted(str(r["dtime_utc"]) for r in made.answer((), unit="month").collect()) == ["2026-01-01 00:00:00", "None"]
    delete_path(spark, f"{path}/part_date=__HIVE_DEFAULT_PARTITION__")
    made.refresh(path)
    assert made.answer((), with_count=True).first()["row_count"] == 1


def test_declared_rollups():
    assert set(ROLLUPS) == set(MODELS)
    with pytest.raises(ValueError, match="first rollup"):
        RollupStore(None, "x", PRICES, [Rollup("a", ("currency",)), Rollup("b", ("area_map_code",), "month")])
