"""File-based operators run on data Spark derives from the driver's tables.

Each query lands or writes derived data under the shared checkpoint folder
(a fresh folder per call), runs the operator on the files, and returns what
it produced; the SQL twin computes the same rows from the tables directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.pages import read_pages
from ..sources.tsv import instrument_headers, scan_instrument
from . import oracle, sync, testbed
from .export import export_csv_by_year, merge_monthly_tsv
from ..operators.upsert import upsert_table

_PRICE_COLUMNS = ["datetime", "resolution_code", "area_code", "area_name", "area_type_code",
                  "area_map_code", "contract_type", "price", "currency", "update_time"]


def land_prices_two_layouts(raw: DataFrame, landing: str, files: int = 4) -> None:
    """Raw-price rows as header-named TSV files in two column orders.

    Rows of even and odd load ids go to files whose headers are in opposite
    orders; every row is landed exactly once.
    """
    names = {t: h for h, t in instrument_headers("energy_prices").items()}
    text = []
    for c in _PRICE_COLUMNS:
        if c == "datetime":
            v = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif c == "update_time":
            v = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            v = F.col(c)
        text.append(v.alias(names[c]))
    even = F.col("load_id") % 2 == 0
    for cond, cols in [(even, text), (~even, list(reversed(text)))]:
        (raw.where(cond).select(*cols).repartition(files)
         .write.mode("append").option("sep", "\t").option("header", True)
         .option("quote", '"').option("escape", '"').csv(landing))


def q_tsv_scan_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-two-layouts")
    land_prices_two_layouts(testbed.raw_prices(spark, sf_dir), landing)
    return testbed.ntz(scan_instrument(spark, landing, "energy_prices").drop("file_path"))


def q_merge_monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing-months")
    land_prices_two_layouts(testbed.raw_prices(spark, sf_dir), landing)
    out = scratch_path(spark, "merged") + "/energy_prices_2024_NATION_3.csv"
    merge_monthly_tsv(spark, landing, out, area="NATION_3")
    return testbed.ntz(scan_instrument(spark, out, "energy_prices").drop("file_path"))


def q_upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = testbed._orders_upsert_parts(spark, sf_dir)
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("part_month")
    path = scratch_path(spark, "orders-mart")
    upsert_table(spark, path, target.withColumn("part_month", month), ["o_orderkey"],
                 "part_month")
    upsert_table(spark, path, source.withColumn("part_month", month), ["o_orderkey"],
                 "part_month")
    return spark.read.parquet(path).drop("part_month")


def q_sync_refresh_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    local, remote = testbed._events_replica(spark, sf_dir)
    path = scratch_path(spark, "replica-events")
    wm = scratch_path(spark, "replica-watermark")
    first, _ = sync.sync_table(spark, remote, path, "events", "ts", watermark_path=wm)
    second, _ = sync.sync_table(spark, local, path, "events", "ts", overlap_days=2,
                                watermark_path=wm)
    if (first, second) != ("full-copy", "append"):
        raise RuntimeError(f"unexpected sync actions {first}, {second}")
    return spark.read.parquet(path).drop(sync.PART)


def q_export_year_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testbed._t(spark, sf_dir, "orders")
    out = scratch_path(spark, "export")
    export_csv_by_year({"orders": orders}, [1997], out, ts_col="o_orderdate")
    schema = orders.schema
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .csv(f"{out}/orders_1997.csv"))


def q_pages_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = testbed._t(spark, sf_dir, "events")
    row = F.struct("event_id", "props")
    page = F.when(F.col("event_type") == "error",
                  F.to_json(F.struct(F.lit("end").alias("nextLink")))) \
        .otherwise(F.to_json(F.struct(F.array(row).alias("value"),
                                      F.lit("next").alias("nextLink"))))
    landing = scratch_path(spark, "landing-pages")
    ev.select(page.alias("value")).write.mode("overwrite").text(landing)
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("props", T.StringType())])
    rows = read_pages(spark, landing, schema, multi_line=False)
    return rows.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def q_ingest_and_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G2 on a landing area Spark builds from the events: three day
    slices of raw prices (each a folder of part files in two header
    layouts) and an export log listing them; the price mart is returned."""
    from ..schemas import INSTRUMENTS
    from .orchestrate import run_entsoe, run_models
    root = scratch_path(spark, "lake")
    folder = INSTRUMENTS["energy_prices"].folder
    raw = testbed.raw_prices(spark, sf_dir)
    day = F.dayofmonth("datetime")
    slices = [("2024_01_01", day < 11), ("2024_01_11", (day >= 11) & (day < 21)),
              ("2024_01_21", day >= 21)]
    names = []
    for prefix, cond in slices:
        name = f"{prefix}_{folder}.csv"
        land_prices_two_layouts(raw.where(cond), f"{root}/landing/{folder}/{name}", files=2)
        names.append((name, cond))
    label = F.lit(None).cast("string")
    for name, cond in reversed(names):
        label = F.when(cond, F.lit(name)).otherwise(label)
    log = (raw.groupBy(label.alias("file_name"))
           .agg(F.date_format(F.max("update_time"), "yyyy-MM-dd'T'HH:mm:ss")
                .alias("max_update_time(UTC)")))
    (log.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True)
     .csv(f"{root}/manifest"))
    loaded = run_entsoe(spark, root, instruments=["energy_prices"])
    if loaded != {"energy_prices": 3}:
        raise RuntimeError(f"unexpected ingest report {loaded}")
    built = run_models(spark, root, checks=False)
    return testbed.ntz(spark.read.parquet(built["fct_energy_prices"]).drop("part_date"))


QUERIES = {
    "ingest_and_models": q_ingest_and_models,
    "tsv_scan_by_name": q_tsv_scan_by_name,
    "merge_monthly_files": q_merge_monthly_files,
    "upsert_partitioned": q_upsert_partitioned,
    "sync_refresh_paths": q_sync_refresh_paths,
    "export_year_csv": q_export_year_csv,
    "pages_files": q_pages_files,
}

_LANDED = """
SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
       contract_type, trim(price) AS price, currency, update_time
FROM raw_prices"""

SQL = {
    # one load: ties on the load id fall to the newest update time
    "ingest_and_models": oracle.SQL["fct_prices"].replace(
        "ORDER BY load_id DESC", "ORDER BY update_time DESC"),
    "tsv_scan_by_name": "WITH " + oracle.RAW_PRICES + _LANDED,
    "merge_monthly_files": "WITH " + oracle.RAW_PRICES + _LANDED
    + "\nWHERE area_map_code = 'NATION_3'",
    "upsert_partitioned": oracle.SQL["upsert_keyed"],
    "sync_refresh_paths": oracle.SQL["replace_window_overlap"],
    "export_year_csv": oracle.SQL["year_slice"],
    "pages_files": oracle.SQL["json_rows"],
}
