"""Byte ranges of quoted text and the layout index, on files Spark lands from the events."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_version, scratch_path
from ..sources.layouts import list_files
from ..sources.records import quoted_records
from ..sources.tsv import instrument_headers, scan_instrument
from . import oracle, testbed
from .testbed_files import land_prices_two_layouts

_SPLIT = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@contextmanager
def _splits_of(spark: SparkSession, size: int):
    """Inside, files are cut into ranges of ``size`` bytes."""
    before = [spark.conf.get(k) for k in _SPLIT]
    for k in _SPLIT:
        spark.conf.set(k, str(size))
    try:
        yield
    finally:
        for k, v in zip(_SPLIT, before, strict=True):
            spark.conf.set(k, v)


def q_tsv_quoted_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw prices in one file whose names hold quotes, tabs and newlines, read as 24 byte ranges or more."""
    raw = testbed.raw_prices(spark, sf_dir)
    name = F.concat(F.lit('"'), "area_name", F.lit('"\t('), F.col("load_id").cast("string"), F.lit(')\n'),
                    F.repeat(F.lit('"\n'), (F.col("load_id") % 5).cast("int")), "area_code")
    names = {t: h for h, t in instrument_headers("energy_prices").items()}
    text = {"datetime": F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"), "area_name": name,
            "update_time": F.date_format("update_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")}
    landing = scratch_path(spark, "landing-quoted")
    (raw.select(*[text.get(t, F.col(t)).alias(h) for t, h in names.items()]).coalesce(1).write
     .option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(landing))
    size = list_files(spark, [landing]).agg(F.sum("length")).first()[0]
    out = scratch_path(spark, "quoted-rows")
    with _splits_of(spark, size // 24 + 1):
        ranges = quoted_records(spark, [landing]).select(F.spark_partition_id().alias("p")).distinct().count()
        if ranges < 24:
            raise RuntimeError(f"one file was read by {ranges} tasks only")
        scan_instrument(spark, landing, "energy_prices").drop("file_path").write.parquet(out)
    return testbed.ntz(spark.read.parquet(out))


def q_tsv_layout_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index is filled from half of the files; then more arrive, in both layouts, and it is read with them.

    Rows, with the number of files that the index knows of before and after.
    """
    raw = testbed.raw_prices(spark, sf_dir)
    landing, index = scratch_path(spark, "landing-index"), scratch_path(spark, "layout-index")

    def known() -> int:
        return read_version(spark, index).select("file_path").distinct().count()

    land_prices_two_layouts(raw.where("load_id % 3 = 0"), landing, files=2)
    scan_instrument(spark, landing, "energy_prices", index_path=index)
    first = known()
    land_prices_two_layouts(raw.where("load_id % 3 <> 0"), landing, files=3)
    rows = scan_instrument(spark, landing, "energy_prices", index_path=index).drop("file_path")
    return testbed.ntz(rows).select("*", F.lit(first).alias("files_before"), F.lit(known()).alias("files_after"))


QUERIES = {"tsv_quoted_ranges": q_tsv_quoted_ranges, "tsv_layout_index": q_tsv_layout_index}

_ROWS = """
SELECT datetime, resolution_code, area_code, {name} AS area_name, area_type_code, area_map_code,
       contract_type, trim(price) AS price, currency, update_time{more}
FROM raw_prices"""

SQL = {
    "tsv_quoted_ranges": "WITH " + oracle.RAW_PRICES + _ROWS.format(
        name="""'"' || area_name || '"' || chr(9) || '(' || load_id || ')' || chr(10)
       || repeat('"' || chr(10), CAST(load_id % 5 AS INTEGER)) || area_code""", more=""),
    "tsv_layout_index": "WITH " + oracle.RAW_PRICES + _ROWS.format(
        name="area_name", more=", 4 AS files_before, 10 AS files_after"),
}
