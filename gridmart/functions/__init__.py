"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from .categories import (forecast_category, imbalance_direction,
                         imbalance_price_category, like_case, measure_category)
from .numeric import try_double
from .text import (filename_to_folder, normalize_filename, strip_text,
                   text_or_empty, year_prefix)
from .timeutc import (format_utc, now_utc_text, parse_utc, to_date_strict,
                      utc_reject_reason, utc_value, with_utc)

__all__ = [
    "forecast_category", "imbalance_direction", "imbalance_price_category",
    "like_case", "measure_category", "try_double", "filename_to_folder",
    "normalize_filename", "strip_text", "text_or_empty", "year_prefix",
    "format_utc", "now_utc_text", "parse_utc", "to_date_strict",
    "utc_reject_reason", "utc_value", "with_utc",
]
