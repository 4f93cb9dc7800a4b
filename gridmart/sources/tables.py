"""Whole tables or named column subsets (Parquet paths or catalog)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        df = spark.read.parquet(name_or_path)
    else:
        df = spark.table(name_or_path)
    return df.select(*columns) if columns else df


def read_sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
