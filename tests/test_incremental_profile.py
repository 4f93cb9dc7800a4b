"""Increments, watermark, previews and ad hoc SQL."""

import datetime as dt

from pyspark.sql import functions as F

from gridmart.operators import incremental as I
from gridmart.operators import profile as P
from gridmart.operators.metrics import adhoc_sql, metric_query


def events(spark):
    return spark.createDataFrame(
        [(1, dt.datetime(2026, 9, 1, 10)), (2, dt.datetime(2026, 9, 2, 10)),
         (3, dt.datetime(2026, 9, 3, 10))], "id int, ts timestamp_ntz")


def test_since_is_strict_and_needs_baseline(spark):
    ev = events(spark)
    assert I.incremental_since(ev, "ts", "2026-09-02 10:00:00").count() == 1
    assert I.incremental_since(ev, "ts", None).count() == 0


def test_watermark_never_lowered(spark):
    ev = events(spark)
    assert I.advance_watermark(ev, "ts", "2026-09-10 00:00:00").first()[0] == \
        "2026-09-10 00:00:00.000000"
    assert I.advance_watermark(ev, "ts", "2026-09-01 00:00:00").first()[0] == \
        "2026-09-03 10:00:00.000000"


def test_days():
    today = dt.date(2026, 9, 10)
    assert I.lookback_days(3, today) == ["2026-09-10", "2026-09-09", "2026-09-08"]
    assert I.dates_from("2026-09-09", today) == ["2026-09-09", "2026-09-10"]
    assert I.dates_from("2026-09-11", today) == []
    assert I.backfill_start(0) is None
    assert I.backfill_start(2, dt.datetime(2026, 9, 10, 12, tzinfo=dt.timezone.utc)) == \
        "2026-09-08 12:00:00"


def test_business_days(spark):
    ev = events(spark)
    assert I.by_time_days(ev, "ts", ["2026-09-01", "2026-09-03"]).count() == 2
    d = ev.withColumn("business_date", F.to_date("ts"))
    assert I.by_business_dates(d, "business_date", ["2026-09-02"]).count() == 1
    assert I.days_frame(d.sparkSession, "2026-09-01", "2026-09-03").count() == 3


def test_preview_latest_and_sql(spark):
    ev = events(spark)
    assert P.preview(ev, 2).count() == 2
    assert P.latest_one(ev, "ts").first()["id"] == 3
    out = adhoc_sql(spark, {"fct_x": ev}, "select count(*) as n from fct_x").first()["n"]
    assert out == 3


def test_metric_query_grain_and_unknown(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 9, 1, 1), "PL", 1.0),
                                (dt.datetime(2026, 9, 1, 2), "PL", 3.0)],
                               "datetime timestamp, area_map_code string, price double")
    out = metric_query(df, "fct_energy_prices", dims=["datetime"], grain={"datetime": "day"},
                       metrics=["average_price"]).collect()
    assert len(out) == 1 and out[0]["average_price"] == 2.0
    import pytest
    with pytest.raises(KeyError):
        metric_query(df, "fct_energy_prices", metrics=["nope"])
