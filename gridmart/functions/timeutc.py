"""Strict UTC typing of timestamp text.

A value is accepted when, after stripping, it has the fixed shape below, is a
real calendar instant, and carries no offset or a zero offset.  Naive text is
taken as UTC.  Spark's own cast accepts more (a bare date, non-zero offsets
which it shifts), so shape and offset are tested before the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_text

# Fixed value: accepted shape of a UTC timestamp text (date, 'T' or space,
# HH:MM, optional :SS with 1-9 fraction digits, optional Z / +-HH:MM / +-HHMM).
UTC_TEXT_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})?$"
)
# The same shape with no offset or a zero one: what is accepted.
ACCEPTED = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|[+-]00:?00)?$"
)

API_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
NOW_FORMAT = "yyyy-MM-dd HH:mm:ss"

MISSING = "missing"
MALFORMED = "malformed"
NON_UTC = "non-UTC offset"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _naive_instant(text: Column) -> Column:
    """The instant of a shape-checked text (NULL if not a real calendar time).

    Spark's cast reads the 'T' separator, fractions (cut to microseconds) and
    zero offsets itself; text without seconds gets ':00' inserted after the
    16-character 'YYYY-MM-DD HH:MM' head.  Non-zero offsets are rejected
    before this value is used, so the session zone (UTC) is the only one
    that applies.
    """
    head, rest = text.substr(1, 16), text.substr(17, 64)
    no_seconds = rest.substr(1, 1) != ":"
    full = F.when(no_seconds, F.concat(head, F.lit(":00"), rest)).otherwise(text)
    return full.try_cast("timestamp")


def utc_value(c) -> Column:
    """The UTC instant of an acceptable value; NULL for blank or rejected text."""
    text = strip_text(_col(c))
    return F.when(text.rlike(ACCEPTED), _naive_instant(text))


def utc_reject_reason(c, required: bool = True) -> Column:
    """NULL for an acceptable value, else 'missing' / 'malformed' / 'non-UTC offset'.

    Only a value without an instant is looked at further, so good rows cost
    one match and one cast.
    """
    text = strip_text(_col(c))
    shaped = text.rlike(UTC_TEXT_SHAPE) & _naive_instant(text).isNotNull()
    return (F.when(utc_value(c).isNotNull(), F.lit(None).cast("string"))
            .when(text.isNull() | (text == ""), F.lit(MISSING if required else None).cast("string"))
            .when(shaped, F.lit(NON_UTC)).otherwise(F.lit(MALFORMED)))


def parse_utc(c, field: str = "value", source: str = "gridmart",
              required: bool = True, on_error: str = "fail") -> Column:
    """UTC timestamp from text.

    ``on_error="fail"`` aborts the job on the first rejected value (the
    source's behaviour); ``"null"`` yields NULL and leaves rejects to
    :func:`gridmart.operators.quality.split_rejects`.
    """
    c = _col(c)
    value, text = utc_value(c), strip_text(c)
    if on_error == "null":
        return value
    why = utc_reject_reason(c, required)
    message = F.concat(F.lit(f"{source} column {field} holds no UTC instant, {{"), why,
                       F.lit("}: "), F.coalesce(c, F.lit("NULL")))
    out = F.when(value.isNotNull(), value)
    if not required:
        out = out.when(text.isNull() | (text == ""), F.lit(None).cast("timestamp"))
    return out.otherwise(F.raise_error(message))


def format_utc(c) -> Column:
    """Text form 'YYYY-MM-DD HH:MM:SS.ffffff' (session time zone is UTC)."""
    return F.date_format(_col(c), API_FORMAT)


def now_utc_text() -> Column:
    return F.date_format(F.current_timestamp(), NOW_FORMAT)


def to_date_strict(c) -> Column:
    """Text to DATE; only Y-M-D text is taken (Spark alone also takes '2026')."""
    c = _col(c)
    text = strip_text(c)
    ok = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    message = F.concat(F.lit("invalid date: "), F.coalesce(c, F.lit("NULL")))
    return (F.when(c.isNull(), F.lit(None).cast("date"))
            .when(ok, text.cast("date"))
            .otherwise(F.raise_error(message)))


def with_utc(df, col: str, required: bool = True, on_error: str = "fail",
             field: str | None = None, source: str = "gridmart",
             reason_col: str | None = None):
    """Parse one text column of a DataFrame in place (see :func:`parse_utc`).

    ``on_error``: "fail" aborts the job on a rejected value, "null" leaves
    NULL.  ``reason_col`` also keeps the reject reason.
    """
    new = {col: parse_utc(col, field or col, source, required, on_error)}
    if reason_col:
        new[reason_col] = utc_reject_reason(col, required)
    return df.withColumns(new)
