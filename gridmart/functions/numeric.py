"""Lenient text -> double conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast alone also takes type suffixes ('1d', '1e3f') and hex floats
# ('0x1p3'); the guard keeps it to plain decimal, exponent, inf and nan forms.
_NUMBER = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*$"


def try_double(c) -> Column:
    """Text to double; blank or malformed text gives NULL, never an error."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))
