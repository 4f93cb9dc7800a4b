"""Text helpers: stripping, file-name algebra."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source strips with Python's str.strip(): every character for which
# str.isspace() is true (tabs, newlines, no-break and other Unicode spaces).
# Spark's trim() with a character set does the same without a regex; the set
# is built from that rule (all such characters lie below U+3001).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    return F.trim(_col(c), F.lit(WHITESPACE))


def text_or_empty(c) -> Column:
    """Missing becomes '' and every value is stripped (raw text columns)."""
    return F.coalesce(strip_text(c), F.lit(""))


def filename_to_folder(c) -> Column:
    """Drop a .csv suffix (any case), then a leading YYYY_MM_ or YYYY_MM_DD_."""
    no_ext = F.regexp_replace(_col(c), r"(?i)\.csv$", "")
    return F.regexp_replace(no_ext, r"^\d{4}_\d{2}(?:_\d{2})?_", "")


def normalize_filename(c) -> Column:
    """Append .csv unless the name already ends in it (any case)."""
    c = _col(c)
    return F.when(F.lower(c).endswith(".csv"), c).otherwise(F.concat(c, F.lit(".csv")))


def year_prefix(c) -> Column:
    """First four characters of a file name (its year)."""
    return F.substring(_col(c), 1, 4)
