"""Row increments: publication watermark and business days."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutc import API_FORMAT, NOW_FORMAT, utc_value


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    return utc_value(F.lit(str(value)))


def incremental_since(df: DataFrame, ts_col: str, last) -> DataFrame:
    """Rows strictly newer than the watermark.  I8: no watermark, no rows."""
    if last is None or (isinstance(last, str) and not last.strip()):
        return df.where(F.lit(False))
    bound = _ts(last)
    if dict(df.dtypes).get(ts_col) == "timestamp_ntz":
        bound = bound.cast("timestamp_ntz")
    return df.where(F.col(ts_col) > bound)


def advance_watermark(df: DataFrame, ts_col: str, start) -> DataFrame:
    """New watermark text = greatest(start, max seen); never lowered."""
    start_ts = _ts(start)
    mx = F.max(F.col(ts_col).cast("timestamp"))
    return df.agg(F.date_format(F.greatest(start_ts, F.coalesce(mx, start_ts)),
                                API_FORMAT).alias("watermark"))


def by_business_dates(df: DataFrame, date_col: str, dates: Iterable) -> DataFrame:
    """Rows of an explicit list of days (a short, user-given list)."""
    days = sorted({str(d) for d in dates})
    return df.where(F.col(date_col).cast("date").isin([F.lit(d).cast("date") for d in days]))


def day_ranges(dates: Iterable) -> list[tuple[_dt.date, _dt.date]]:
    """Sorted days merged into half-open [first, last + 1 day) ranges."""
    days = sorted({d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))
                   for d in dates})
    ranges: list[list[_dt.date]] = []
    for d in days:
        if ranges and ranges[-1][1] == d:
            ranges[-1][1] = d + _dt.timedelta(days=1)
        else:
            ranges.append([d, d + _dt.timedelta(days=1)])
    return [(a, b) for a, b in ranges]


def by_time_days(df: DataFrame, ts_col: str, dates: Iterable) -> DataFrame:
    """I3 on an instant column: the days as merged half-open ranges, so the
    predicate is a few plain comparisons the Parquet scan can push down
    (a two-year backfill is one range, not 730)."""
    cond = None
    kind = dict(df.dtypes)[ts_col]
    for lo_d, hi_d in day_ranges(dates):
        lo = F.lit(lo_d.isoformat()).cast("date").cast(kind)
        hi = F.lit(hi_d.isoformat()).cast("date").cast(kind)
        c = (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)
        cond = c if cond is None else (cond | c)
    return df.where(cond if cond is not None else F.lit(False))


def lookback_days(n: int = 3, today: _dt.date | None = None) -> list[str]:
    """I4: the last n days including today (default 3)."""
    today = today or _dt.datetime.now(_dt.timezone.utc).date()
    return [(today - _dt.timedelta(days=i)).isoformat() for i in range(n)]


def dates_from(start, today: _dt.date | None = None) -> list[str]:
    """Every day from ``start`` to today; empty if start is in the future."""
    today = today or _dt.datetime.now(_dt.timezone.utc).date()
    d = start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start))
    out = []
    while d <= today:
        out.append(d.isoformat())
        d += _dt.timedelta(days=1)
    return out


def days_frame(spark: SparkSession, start, end) -> DataFrame:
    """I5 as a DataFrame of dates (for semi joins on a date column)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"),
                             F.lit(str(end)).cast("date"))).alias("business_date")
    ).where(F.col("business_date").isNotNull())


def backfill_start(days: int | None, now: _dt.datetime | None = None) -> str | None:
    """now(UTC) minus N days as text; 0 or None means off."""
    if not days:
        return None
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return (now - _dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")


def seed_watermark(spark: SparkSession) -> DataFrame:
    """state = now (UTC text), no rows loaded."""
    return spark.range(1).select(F.date_format(F.current_timestamp(), NOW_FORMAT)
                                 .alias("watermark"))
