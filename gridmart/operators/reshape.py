"""Wide to long (R1) with the derived category columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 name_col: str, value_col: str,
                 keep_names: Sequence[str] | None = None) -> DataFrame:
    """UNPIVOT with SQL semantics: rows whose value is NULL are dropped.

    ``DataFrame.unpivot`` keeps NULL rows, so the filter is always added.
    A filter on the produced *name* is not pushed below the Expand by
    Catalyst; pass ``keep_names`` to narrow the value columns up front so
    the others are neither read nor expanded.
    """
    values = list(values)
    if keep_names is not None:
        unknown = sorted(set(keep_names) - set(values))
        if unknown:
            raise ValueError("unknown names: " + ", ".join(unknown))
        values = [v for v in values if v in set(keep_names)]
        if not values:
            raise ValueError("no names to keep")
    return (df.unpivot(list(ids), values, name_col, value_col)
            .where(F.col(value_col).isNotNull()))
