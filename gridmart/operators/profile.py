"""Counts, ranges, distinct values, previews and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType)


def count_rows(df: DataFrame, where=None) -> DataFrame:
    """A1: count(*) (optionally of a predicate) as a one-row DataFrame."""
    if where is not None:
        df = df.where(where)
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def max_ts(df: DataFrame, col: str) -> DataFrame:
    """A2: max of a column; NULL on an empty table."""
    return df.agg(F.max(col).alias("max_value"))


def min_max_range(df: DataFrame, col: str) -> DataFrame:
    """A3: min and max of the time column, with the row count."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"),
                  F.count(F.lit(1)).alias("row_count"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4: sorted distinct values of one column (NULLs last)."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_last())


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: SELECT DISTINCT of some columns, ordered by the first (NULLs last)."""
    return df.select(*cols).distinct().orderBy(F.col(cols[0]).asc_nulls_last())


def order_by(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending sort, NULLs last (DuckDB's order in both directions)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First n rows, no order."""
    return df.limit(n)


def latest_one(df: DataFrame, col: str) -> DataFrame:
    """Top-1 by a column (descending, NULLs last)."""
    return df.orderBy(F.col(col).desc_nulls_last()).limit(1)


def price_series(prices: DataFrame, area: str, contract: str, resolution: str,
                 time_col: str = "datetime", value_col: str = "price") -> DataFrame:
    """T8 (with P2): one series, ordered by time."""
    return (prices.where((F.col("area_map_code") == area)
                         & (F.col("contract_type") == contract)
                         & (F.col("resolution_code") == resolution))
            .select(time_col, value_col)
            .orderBy(F.col(time_col).asc_nulls_last()))


def time_column(schema: T.StructType) -> str | None:
    """`datetime` if present, else the first timestamp column, else None."""
    names = [f.name for f in schema.fields]
    if "datetime" in names:
        return "datetime"
    for f in schema.fields:
        if isinstance(f.dataType, _TIME_TYPES):
            return f.name
    return None


def profile_table(df: DataFrame, name: str, schema_name: str = "") -> DataFrame:
    """T7 for one table, in a single aggregation pass.

    One row: schema, table, column count, column list with types, row count,
    time column and its min / max as text.
    """
    tcol = time_column(df.schema)
    described = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if tcol:
        fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
        aggs += [F.date_format(F.min(tcol), fmt).alias("min_time"),
                 F.date_format(F.max(tcol), fmt).alias("max_time")]
    else:
        aggs += [F.lit(None).cast("string").alias("min_time"),
                 F.lit(None).cast("string").alias("max_time")]
    return (df.agg(*aggs)
            .select(F.lit(schema_name).alias("schema_name"), F.lit(name).alias("table_name"),
                    F.lit(len(df.columns)).cast("int").alias("n_columns"),
                    F.lit(described).alias("columns"), "row_count",
                    F.lit(tcol).cast("string").alias("time_column"), "min_time", "max_time"))


def profile_tables(tables: Mapping[str, DataFrame], schema_name: str = "",
                   exclude_prefix: str = "_dlt") -> DataFrame:
    """Profile every table (names with the prefix left out), by name."""
    out = None
    for name in sorted(tables):
        db, _, bare = name.rpartition(".")
        if bare.startswith(exclude_prefix):
            continue
        one = profile_table(tables[name], bare, db or schema_name)
        out = one if out is None else out.unionByName(one)
    return out


def catalog_tables(spark: SparkSession, schemas: Sequence[str]) -> dict[str, DataFrame]:
    """Tables of the given catalog schemas (databases), for profile_tables."""
    found = {}
    for db in schemas:
        for t in spark.catalog.listTables(db):
            found[f"{db}.{t.name}"] = spark.table(f"{db}.{t.name}")
    return found
