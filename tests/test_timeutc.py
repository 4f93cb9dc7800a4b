"""UTC typing: the source's eight cases plus the shapes its pattern allows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmart.functions import format_utc, parse_utc, utc_reject_reason, utc_value

UTC = dt.timezone.utc


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "s string").select(fn(F.col("s")).alias("v")) \
        .collect()[0]["v"]


def as_utc(v):
    return v.replace(tzinfo=UTC) if v is not None and v.tzinfo is None else v


def test_naive_declared_utc_becomes_utc(spark):
    assert as_utc(one(spark, "2026-07-01 08:45:00", utc_value)) == \
        dt.datetime(2026, 7, 1, 8, 45, tzinfo=UTC)


def test_fractional_seconds_preserved(spark):
    assert as_utc(one(spark, "2026-09-08 05:58:42.265000", utc_value)) == \
        dt.datetime(2026, 9, 8, 5, 58, 42, 265000, tzinfo=UTC)


def test_explicit_zero_offset_normalized(spark):
    assert as_utc(one(spark, "2026-07-01T08:45:00+00:00", utc_value)) == \
        dt.datetime(2026, 7, 1, 8, 45, tzinfo=UTC)


def test_optional_empty_is_null(spark):
    assert one(spark, "", lambda c: utc_reject_reason(c, required=False)) is None
    assert one(spark, "", utc_value) is None


def test_required_empty_fails(spark):
    with pytest.raises(Exception):
        one(spark, "", lambda c: parse_utc(c, "DateTime(UTC)", "entsoe"))


@pytest.mark.parametrize("bad", ["2026-13-01 08:45:00", "2026-07-01", "not-a-date"])
def test_malformed_fails(spark, bad):
    assert one(spark, bad, utc_reject_reason) == "malformed"
    with pytest.raises(Exception):
        one(spark, bad, lambda c: parse_utc(c, "DateTime(UTC)", "entsoe"))


def test_non_utc_offset_fails(spark):
    assert one(spark, "2026-07-01 08:45:00+02:00", utc_reject_reason) == "non-UTC offset"
    with pytest.raises(Exception):
        one(spark, "2026-07-01 08:45:00+02:00", lambda c: parse_utc(c, "x", "entsoe"))


def test_format_round_trip(spark):
    assert one(spark, "2026-09-08 05:58:42.265", lambda c: format_utc(utc_value(c))) == \
        "2026-09-08 05:58:42.265000"


@pytest.mark.parametrize("text,expected", [
    ("2026-07-01 08:45", dt.datetime(2026, 7, 1, 8, 45)),
    ("2026-07-01T08:45:00Z", dt.datetime(2026, 7, 1, 8, 45)),
    ("2026-07-01 08:45:00+0000", dt.datetime(2026, 7, 1, 8, 45)),
    ("2026-07-01 08:45:00-00:00", dt.datetime(2026, 7, 1, 8, 45)),
    ("2026-07-01 08:45:00.123456789", dt.datetime(2026, 7, 1, 8, 45, 0, 123456)),
    ("2026-07-01T08:45Z", dt.datetime(2026, 7, 1, 8, 45)),
    ("2026-07-01 08:45+0000", dt.datetime(2026, 7, 1, 8, 45)),
    ("\u3000 2026-07-01 08:45:00\u2028", dt.datetime(2026, 7, 1, 8, 45)),
    ("\t2026-07-01 08:45:00 ", dt.datetime(2026, 7, 1, 8, 45)),
])
def test_accepted_shapes(spark, text, expected):
    assert as_utc(one(spark, text, utc_value)) == expected.replace(tzinfo=UTC)


@pytest.mark.parametrize("bad", ["2026-02-30 00:00:00", "2026-07-01 24:00:00",
                                 "2026-07-01 08:45:00.1234567890", "2026-07-01 8:45"])
def test_rejected_shapes(spark, bad):
    assert one(spark, bad, utc_reject_reason) == "malformed"
