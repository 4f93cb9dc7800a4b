"""Property check: the Spark parse agrees with a plain-Python model of the
rules (shape pattern, calendar check by datetime.fromisoformat, zero offset)
on a few thousand generated texts, in one Spark job."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from gridmart.functions.timeutc import UTC_TEXT_SHAPE, utc_reject_reason, utc_value

SHAPE = re.compile(UTC_TEXT_SHAPE)


def model(text):
    """(reason, naive UTC datetime) by the written rules."""
    if text is None or not text.strip():
        return "missing", None
    t = text.strip()
    if not SHAPE.match(t):
        return "malformed", None
    try:
        parsed = dt.datetime.fromisoformat(t)
    except ValueError:
        return "malformed", None
    if parsed.tzinfo is not None:
        if parsed.utcoffset() != dt.timedelta(0):
            return "non-UTC offset", None
        parsed = parsed.replace(tzinfo=None)
    return None, parsed.replace(microsecond=parsed.microsecond)


def generate(n, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        y = rnd.choice(["2026", "1999", "2024", "1900"])
        mo = rnd.choice(["01", "02", "07", "12", "13", "00"])
        d = rnd.choice(["01", "15", "28", "29", "30", "31", "32"])
        h = rnd.choice(["00", "08", "23", "24"])
        mi = rnd.choice(["00", "45", "59", "60"])
        sec = rnd.choice(["", ":00", ":59", ":60", ":07.1", ":07.265000", ":07.123456789",
                          ":07.1234567890"])
        sep = rnd.choice(["T", " ", " ", "t"])
        off = rnd.choice(["", "", "Z", "+00:00", "-00:00", "+0000", "+02:00", "-0130",
                          "+00:30", "z"])
        pad = rnd.choice(["", "", " ", "\t", " "])
        text = f"{pad}{y}-{mo}-{d}{sep}{h}:{mi}{sec}{off}{pad}"
        if rnd.random() < 0.05:
            text = rnd.choice(["", "  ", "2026-07-01", "not-a-date", "2026-7-1 08:45"])
        out.append(text)
    return out


def test_parse_agrees_with_rules(spark):
    texts = generate(3000)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: (r["reason"], r["value"]) for r in df.select(
        "i", utc_reject_reason("s").alias("reason"), utc_value("s").alias("value")).collect()}
    bad = []
    for i, t in enumerate(texts):
        want = model(t)
        g_reason, g_val = got[i]
        # the value is the instant only for accepted texts (see with_utc)
        g_val = g_val.replace(tzinfo=None) if g_val is not None and g_reason is None else None
        if (g_reason, g_val) != want:
            bad.append((t, want, (g_reason, g_val)))
    assert not bad, bad[:10]
