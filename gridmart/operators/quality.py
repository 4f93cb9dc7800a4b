"""Data checks (Q1, Q2) and reject splitting (Q4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutc import with_utc


class DataCheckError(RuntimeError):
    pass


def check_unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Q1: key values that occur more than once (NULL keys ignored).

    A grouped count with partial aggregation; the result holds violations
    only.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    nn = None
    for c in cols:
        cond = F.col(c).isNotNull()
        nn = cond if nn is None else (nn & cond)
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: NULL count per column, all columns in one scan, as long rows."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return wide.unpivot([], list(cols), "column_name", "null_count")


def assert_checks(*violations: DataFrame) -> None:
    """Raise when any check DataFrame has a failing row (one tiny job each)."""
    for v in violations:
        if "null_count" in v.columns:
            bad = v.where(F.col("null_count") > 0).limit(1).collect()
        else:
            bad = v.limit(1).collect()
        if bad:
            raise DataCheckError(f"data check failed: {bad[0].asDict()}")


def split_rejects(df: DataFrame, ts_cols: dict, source: str = "gridmart"):
    """Q4: parse text instants; return (good rows typed, reject rows).

    ``ts_cols`` maps column -> required flag.  Both outputs come from one
    parsed DataFrame.  Rejects carry (source, field, value, reason) plus the
    original row as JSON.
    """
    parsed = df
    for c, req in ts_cols.items():
        parsed = parsed.withColumn(f"__raw_{c}", F.col(c))
        parsed = with_utc(parsed, c, required=req, on_error="null", reason_col=f"__why_{c}")
    first = [F.when(F.col(f"__why_{c}").isNotNull(),
                    F.struct(F.lit(c).alias("field"), F.col(f"__raw_{c}").alias("value"),
                             F.col(f"__why_{c}").alias("reason")))
             for c in ts_cols]
    parsed = parsed.withColumn("__rej", F.coalesce(*first) if first else F.lit(None))
    helpers = [f"__raw_{c}" for c in ts_cols] + [f"__why_{c}" for c in ts_cols]
    good = parsed.where(F.col("__rej").isNull()).drop("__rej", *helpers)
    original = [F.col(f"__raw_{c}").alias(c) if c in ts_cols else F.col(c) for c in df.columns]
    rejects = (parsed.where(F.col("__rej").isNotNull())
               .select(F.lit(source).alias("source"), "__rej.field", "__rej.value",
                       "__rej.reason", F.to_json(F.struct(*original)).alias("row")))
    return good, rejects


# The declared tests of the published models, as (model, column, test).
DECLARED_TESTS = [
    ("dim_area", "area_map_code", "unique"),
    ("dim_area", "area_map_code", "not_null"),
    ("stg_entsoe_generation_forecasts", "datetime", "not_null"),
    ("stg_entsoe_generation_forecasts", "area_code", "not_null"),
    ("stg_entsoe_generation_forecasts", "production_type", "not_null"),
    ("stg_entsoe_imbalance_prices", "datetime", "not_null"),
    ("stg_entsoe_imbalance_prices", "area_map_code", "not_null"),
    ("stg_entsoe_aggregated_generation", "datetime", "not_null"),
    ("stg_entsoe_aggregated_generation", "area_code", "not_null"),
    ("stg_entsoe_aggregated_generation", "production_type", "not_null"),
]


def quality_report(models: dict, tests=None) -> DataFrame:
    """Run declared tests as one report: (model, column_name, test, failures).

    ``failures`` counts NULL rows (not_null) or key values occurring more
    than once (unique).  Each model is scanned once for all its not-null
    tests; models absent from ``models`` are skipped.
    """
    tests = DECLARED_TESTS if tests is None else tests
    out = None
    by_model: dict = {}
    for model, col, test in tests:
        by_model.setdefault(model, []).append((col, test))
    for model, items in by_model.items():
        df = models.get(model)
        if df is None:
            continue
        nn = [c for c, t in items if t == "not_null"]
        if nn:
            part = check_not_null(df, nn).select(
                F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
                F.col("null_count").cast("bigint").alias("failures"))
            out = part if out is None else out.unionByName(part)
        for c in [c for c, t in items if t == "unique"]:
            part = check_unique(df, [c]).agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                F.lit("unique").alias("test"), F.col("failures").cast("bigint"))
            out = part if out is None else out.unionByName(part)
    return out
